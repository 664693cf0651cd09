"""Input schemas of the analyses (DDL)."""

GLOBAL_CHART = (
    "week date, category string, weekly_rank int, show_title string, season_title string, "
    "weekly_hours_viewed long, runtime double, weekly_views long, cumulative_weeks_in_top_10 int"
)
COUNTRY_CHART = (
    "country_name string, week date, category string, weekly_rank int, show_title string, "
    "season_title string, cumulative_weeks_in_top_10 int"
)
AREA_MEASURE = "geoid long, name string, variable string, estimate double, moe double, year int"
AREA_PERMITS = "cbsa long, new_housing_units_permitted int, year int"
INDUSTRY_TITLES = "code string, industry_title string"
WAGES_RAW = "area_fips string, industry_code string, annual_avg_emplvl string, total_annual_wages string"
WAGES = "year int, fips string, industry int, employment int, total_wages double, avg_wage double"
TREES = "tpcondition string, genusspecies string, lon double, lat double"
DISTRICTS = "district int, area double, edges array<struct<x1:double,y1:double,x2:double,y2:double>>"
PAYROLL_LEVELS = "date date, level double"
PAYROLL_REVISIONS = "date date, original double, final double, revision double"
PERMITS_NEWEST = (
    "EventID long, EventType string, StartDateTime string, EndDateTime string, EnteredOn string, "
    "ParkingHeld string, Borough string, CommunityBoard_s string, PolicePrecinct_s string, "
    "Country string, ZipCode_s string"
)
PERMITS_MID = (
    "eventid long, eventtype string, startdatetime timestamp_ntz, enddatetime timestamp_ntz, "
    "enteredon timestamp_ntz, parkingheld string, borough string, communityboard_s string, "
    "policeprecinct_s string, country string, zipcode_s string"
)
PERMITS_OLDEST = (
    "eventid long, eventtype string, startdatetime timestamp_ntz, enddatetime timestamp_ntz, "
    "enteredon timestamp_ntz, borough string, communityboard_s string, policeprecinct_s string, "
    "country string, zipcode_s string, main string, cross_st_1 string, cross_st_2 string"
)
