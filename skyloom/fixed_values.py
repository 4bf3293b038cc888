"""Fixed values.

Everything in this module is a value that results depend on: field names and
column types of each feed, accepted ranges, reference rows of the small
dimensions, default stations, expected task names, path layouts and score
weights. No logic lives here.
"""

# ---------------------------------------------------------------------------
# Feeds.  source field | warehouse column | warehouse type
# ---------------------------------------------------------------------------

OBSERVATION_FIELDS = """
temperature          temperature          decimal(5,2)
feels_like           feels_like           decimal(5,2)
temp_min             temp_min             decimal(5,2)
temp_max             temp_max             decimal(5,2)
pressure             pressure             int
humidity             humidity             int
visibility           visibility           int
wind_speed           wind_speed           decimal(5,2)
wind_deg             wind_deg             int
wind_gust            wind_gust            decimal(5,2)
clouds               cloudiness           int
weather_id           weather_code         int
weather_main         weather_main         string
weather_description  weather_description  string
rain_1h              rain_1h              decimal(5,2)
rain_3h              rain_3h              decimal(5,2)
snow_1h              snow_1h              decimal(5,2)
snow_3h              snow_3h              decimal(5,2)
"""

DAILY_FIELDS = """
temperature_2m_max           temp_max                    decimal(5,2)
temperature_2m_min           temp_min                    decimal(5,2)
apparent_temperature_max     apparent_temp_max           decimal(5,2)
apparent_temperature_min     apparent_temp_min           decimal(5,2)
precipitation_sum            precipitation_sum           decimal(6,2)
rain_sum                     rain_sum                    decimal(6,2)
showers_sum                  showers_sum                 decimal(6,2)
snowfall_sum                 snowfall_sum                decimal(6,2)
precipitation_hours          precipitation_hours         int
wind_speed_10m_max           wind_speed_max              decimal(5,2)
wind_gusts_10m_max           wind_gusts_max              decimal(5,2)
wind_direction_10m_dominant  wind_direction_dominant     int
sunrise                      sunrise                     time
sunset                       sunset                      time
shortwave_radiation_sum      shortwave_radiation_sum     decimal(8,2)
weather_code                 weather_code                int
et0_fao_evapotranspiration   et0_fao_evapotranspiration  decimal(6,2)
"""

HOURLY_FIELDS = """
temperature_2m             temp_2m                    decimal(5,2)
temperature_80m            temp_80m                   decimal(5,2)
apparent_temperature       apparent_temperature       decimal(5,2)
relative_humidity_2m       relative_humidity_2m       int
dew_point_2m               dew_point_2m               decimal(5,2)
precipitation_probability  precipitation_probability  int
precipitation              precipitation              decimal(6,2)
rain                       rain                       decimal(6,2)
snowfall                   snowfall                   decimal(6,2)
pressure_msl               pressure_msl               decimal(7,2)
surface_pressure           surface_pressure           decimal(7,2)
cloud_cover                cloud_cover                int
visibility                 visibility                 decimal(8,2)
uv_index                   uv_index                   decimal(4,2)
wind_speed_10m             wind_speed_10m             decimal(5,2)
wind_direction_10m         wind_direction_10m         int
wind_gusts_10m             wind_gusts_10m             decimal(5,2)
weather_code               weather_code               int
"""

AIR_QUALITY_FIELDS = """
pm10                   pm10                   decimal(8,2)
pm2_5                  pm2_5                  decimal(8,2)
carbon_monoxide        carbon_monoxide        decimal(8,2)
nitrogen_dioxide       nitrogen_dioxide       decimal(8,2)
sulphur_dioxide        sulphur_dioxide        decimal(8,2)
ozone                  ozone                  decimal(8,2)
aerosol_optical_depth  aerosol_optical_depth  decimal(6,4)
dust                   dust                   decimal(8,2)
"""

POLLEN_FIELDS = """
alder_pollen    alder_pollen    int
birch_pollen    birch_pollen    int
grass_pollen    grass_pollen    int
mugwort_pollen  mugwort_pollen  int
olive_pollen    olive_pollen    int
ragweed_pollen  ragweed_pollen  int
"""

# wave_direction_dominant is truncated, every other whole number is rounded
MARINE_FIELDS = """
wave_height_max          wave_height_max          decimal(5,2)
wave_direction_dominant  wave_direction_dominant  truncated int
wave_period_max          wave_period_max          decimal(5,2)
wind_wave_height_max     wind_wave_height_max     decimal(5,2)
swell_wave_height_max    swell_wave_height_max    decimal(5,2)
"""

STATION_DAY_FIELDS = """
temp_avg        temp_avg        decimal(5,2)
temp_min        temp_min        decimal(5,2)
temp_max        temp_max        decimal(5,2)
precipitation   precipitation   decimal(6,2)
wind_speed_avg  wind_speed_avg  decimal(5,2)
wind_gust_max   wind_gust_max   decimal(5,2)
wind_direction  wind_direction  int
sunshine_hours  sunshine_hours  decimal(4,2)
pressure_max    pressure_max    decimal(7,2)
pressure_min    pressure_min    decimal(7,2)
humidity_avg    humidity_avg    decimal(5,2)
humidity_min    humidity_min    decimal(5,2)
humidity_max    humidity_max    decimal(5,2)
"""

# raw key of a climatology record | cleaned numeric column
CLIMATOLOGY_NUMBERS = """
tmed      temp_avg
tmin      temp_min
tmax      temp_max
prec      precipitation
velmedia  wind_speed_avg
racha     wind_gust_max
dir       wind_direction
sol       sunshine_hours
presMax   pressure_max
presMin   pressure_min
hrMedia   humidity_avg
hrMin     humidity_min
hrMax     humidity_max
"""

# ---------------------------------------------------------------------------
# Data source label stored with the facts
# ---------------------------------------------------------------------------

DATA_SOURCE = {
    "observation": "OpenWeather",
    "daily": "Open-Meteo",
    "hourly": "Open-Meteo",
    "air_quality": "Open-Meteo",
    "pollen": "Open-Meteo",
    "station_day": "AEMET",
}

# ---------------------------------------------------------------------------
# Quality suites
# ---------------------------------------------------------------------------

SUITES = {
    "observation": {
        "name": "weather_observation_suite",
        "required": ["city", "temperature", "humidity", "pressure"],
        "ranges": {
            "temperature": (-60.0, 60.0),
            "feels_like": (-80.0, 70.0),
            "temp_min": (-60.0, 60.0),
            "temp_max": (-60.0, 60.0),
            "humidity": (0.0, 100.0),
            "pressure": (870.0, 1084.0),
            "visibility": (0.0, 100000.0),
            "wind_speed": (0.0, 120.0),
            "wind_deg": (0.0, 360.0),
            "wind_gust": (0.0, 150.0),
            "clouds": (0.0, 100.0),
        },
        "threshold": 0.90,
        "critical": ["city", "temperature", "humidity"],
    },
    "daily_forecast": {
        "name": "daily_forecast_suite",
        "required": ["city_name", "time", "temperature_2m_max", "temperature_2m_min"],
        "ranges": {
            "temperature_2m_max": (-60.0, 60.0),
            "temperature_2m_min": (-60.0, 60.0),
            "apparent_temperature_max": (-80.0, 70.0),
            "apparent_temperature_min": (-80.0, 70.0),
            "precipitation_sum": (0.0, 500.0),
            "rain_sum": (0.0, 500.0),
            "showers_sum": (0.0, 200.0),
            "snowfall_sum": (0.0, 200.0),
            "precipitation_hours": (0.0, 24.0),
            "wind_speed_10m_max": (0.0, 120.0),
            "wind_gusts_10m_max": (0.0, 150.0),
            "wind_direction_10m_dominant": (0.0, 360.0),
            "shortwave_radiation_sum": (0.0, 50.0),
            "weather_code": (0.0, 99.0),
            "et0_fao_evapotranspiration": (0.0, 20.0),
        },
        "threshold": 0.85,
        "critical": ["city_name", "time", "temperature_2m_max", "temperature_2m_min"],
    },
    "hourly_forecast": {
        "name": "hourly_forecast_suite",
        "required": ["city_name", "time", "temperature_2m"],
        "ranges": {
            "temperature_2m": (-60.0, 60.0),
            "temperature_80m": (-70.0, 50.0),
            "apparent_temperature": (-80.0, 70.0),
            "relative_humidity_2m": (0.0, 100.0),
            "dew_point_2m": (-80.0, 40.0),
            "precipitation_probability": (0.0, 100.0),
            "precipitation": (0.0, 100.0),
            "rain": (0.0, 100.0),
            "snowfall": (0.0, 50.0),
            "pressure_msl": (870.0, 1084.0),
            "surface_pressure": (500.0, 1084.0),
            "cloud_cover": (0.0, 100.0),
            "visibility": (0.0, 100000.0),
            "uv_index": (0.0, 15.0),
            "wind_speed_10m": (0.0, 120.0),
            "wind_direction_10m": (0.0, 360.0),
            "wind_gusts_10m": (0.0, 150.0),
            "weather_code": (0.0, 99.0),
        },
        "threshold": 0.80,
        "critical": ["city_name", "time", "temperature_2m"],
    },
    "air_quality": {
        "name": "air_quality_suite",
        "required": ["city_name", "time"],
        "ranges": {
            "pm10": (0.0, 1000.0),
            "pm2_5": (0.0, 500.0),
            "carbon_monoxide": (0.0, 50000.0),
            "nitrogen_dioxide": (0.0, 1000.0),
            "sulphur_dioxide": (0.0, 1000.0),
            "ozone": (0.0, 500.0),
            "aerosol_optical_depth": (0.0, 5.0),
            "dust": (0.0, 2000.0),
        },
        "threshold": 0.70,
        "critical": ["city_name", "time"],
    },
    "pollen": {
        "name": "pollen_suite",
        "required": ["city_name", "time"],
        "ranges": {
            "alder_pollen": (0.0, 500.0),
            "birch_pollen": (0.0, 500.0),
            "grass_pollen": (0.0, 500.0),
            "mugwort_pollen": (0.0, 500.0),
            "olive_pollen": (0.0, 500.0),
            "ragweed_pollen": (0.0, 500.0),
        },
        "threshold": 0.60,
        "critical": ["city_name", "time"],
    },
    "marine": {
        "name": "marine_suite",
        "required": ["city_name", "time"],
        "ranges": {
            "wave_height_max": (0.0, 30.0),
            "wave_direction_dominant": (0.0, 360.0),
            "wave_period_max": (0.0, 30.0),
            "wind_wave_height_max": (0.0, 20.0),
            "swell_wave_height_max": (0.0, 25.0),
        },
        "threshold": 0.80,
        "critical": ["city_name", "time"],
    },
}

DEFAULT_MOSTLY = 0.99
DEFAULT_COMPLETENESS = 0.95

SCORE_WEIGHTS = {
    "completeness": 0.30,
    "validity": 0.35,
    "uniqueness": 0.20,
    "freshness": 0.15,
}
OTHER_WEIGHT = 0.25

EXPECT_COLUMN = "expect_column_to_exist"
EXPECT_RANGE = "expect_column_values_to_be_between"
EXPECT_NOT_NULL = "expect_column_values_to_not_be_null"

ADVICE = {
    "completeness": "Improve data completeness for columns: ",
    "validity": "Address validation failures: ",
    "uniqueness": "Investigate and remove duplicate records before loading",
    "freshness": "Data is stale - check extraction pipeline for delays",
    "overall": "Overall data quality is below threshold - review data sources",
}

# ---------------------------------------------------------------------------
# Cities file
# ---------------------------------------------------------------------------

CITY_CSV_COLUMNS = [
    "city_code", "city_name", "latitud", "longitud", "country_code", "is_coastal",
]

# ---------------------------------------------------------------------------
# calendar
# ---------------------------------------------------------------------------

CALENDAR_FIRST_DAY = "2020-01-01"
CALENDAR_LAST_DAY = "2030-12-31"
FIRST_PARTITION_DAY = 20240101
LAST_PARTITION_DAY = 20271231

# ---------------------------------------------------------------------------
# Seasons, layers, severity.  Two seeds of each exist; the second
# is applied over the first.
# season_id, name, hemisphere, season_type, start_month, end_month,
# precipitation_type, is_growing_season, color_code, description
# ---------------------------------------------------------------------------

SEASONS_BASE = [
    (1, "Winter", "North", "Meteorological", 12, 2, "Snow/Rain", False, "#4FC3F7",
     "December-February: coldest months in the Northern Hemisphere"),
    (2, "Spring", "North", "Meteorological", 3, 5, "Rain", True, "#81C784",
     "March-May: warming temperatures with frequent rain"),
    (3, "Summer", "North", "Meteorological", 6, 8, "Convective", True, "#FFD54F",
     "June-August: warmest months, thunderstorm season"),
    (4, "Autumn", "North", "Meteorological", 9, 11, "Rain", False, "#FF8A65",
     "September-November: cooling temperatures, increasing rainfall"),
    (5, "Winter", "South", "Meteorological", 6, 8, "Snow/Rain", False, "#4FC3F7",
     "June-August: coldest months in the Southern Hemisphere"),
    (6, "Spring", "South", "Meteorological", 9, 11, "Rain", True, "#81C784",
     "September-November: warming temperatures"),
    (7, "Summer", "South", "Meteorological", 12, 2, "Convective", True, "#FFD54F",
     "December-February: warmest months"),
    (8, "Autumn", "South", "Meteorological", 3, 5, "Rain", False, "#FF8A65",
     "March-May: cooling temperatures"),
]

SEASONS_LOCAL = [
    (1, "Invierno", "North", "Meteorological", 12, 2, "Normal", False, "#A5F2F3",
     "Diciembre a Febrero"),
    (2, "Primavera", "North", "Meteorological", 3, 5, "Normal", True, "#98FB98",
     "Marzo a Mayo"),
    (3, "Verano", "North", "Meteorological", 6, 8, "Dry", True, "#FFFFE0",
     "Junio a Agosto"),
    (4, "Otoño", "North", "Meteorological", 9, 11, "Wet", False, "#FFD700",
     "Septiembre a Noviembre"),
    (5, "Verano", "South", "Meteorological", 12, 2, "Dry", True, "#FFFFE0",
     "Diciembre a Febrero"),
    (6, "Otoño", "South", "Meteorological", 3, 5, "Wet", False, "#FFD700",
     "Marzo a Mayo"),
    (7, "Invierno", "South", "Meteorological", 6, 8, "Normal", False, "#A5F2F3",
     "Junio a Agosto"),
    (8, "Primavera", "South", "Meteorological", 9, 11, "Normal", True, "#98FB98",
     "Septiembre a Noviembre"),
]

# layer_id, name, medium, vertical_level_m, pressure_hpa, is_standard_wmo,
# layer_category, description
LAYERS_BASE = [
    (1, "Surface (2m)", "Surface", 2.0, None, True, "Near-surface",
     "Standard WMO screen-level: temperature, humidity, dew point at 2m AGL"),
    (2, "Surface (10m)", "Surface", 10.0, None, True, "Near-surface",
     "Standard WMO wind measurement height: wind speed and direction at 10m AGL"),
    (3, "Boundary Layer", "Air", 1000.0, None, False, "Troposphere",
     "Planetary boundary layer (~1 km): turbulent mixing, diurnal cycle"),
    (4, "Lower Troposphere", "Air", 3000.0, 700.0, True, "Troposphere",
     "700 hPa level (~3 km): cloud base, low-level wind patterns"),
    (5, "Mid Troposphere", "Air", 5500.0, 500.0, True, "Troposphere",
     "500 hPa level (~5.5 km): synoptic-scale weather patterns"),
    (6, "Upper Troposphere", "Air", 9000.0, 300.0, True, "Troposphere",
     "300 hPa level (~9 km): jet stream, upper-level divergence"),
    (7, "Tropopause", "Air", 12000.0, 200.0, True, "Tropopause",
     "200 hPa level (~12 km): tropopause boundary"),
    (8, "Lower Stratosphere", "Air", 20000.0, 50.0, True, "Stratosphere",
     "50 hPa level (~20 km): ozone layer, stratospheric dynamics"),
    (9, "Wind (80m)", "Air", 80.0, None, False, "Near-surface",
     "Wind turbine hub height: wind speed at 80m AGL for energy forecasting"),
    (10, "Topsoil (0-10cm)", "Soil", 0.10, None, False, "Soil",
     "Shallow soil layer: soil temperature and moisture at 0-10 cm depth"),
    (11, "Subsoil (10-40cm)", "Soil", 0.40, None, False, "Soil",
     "Root zone: soil moisture at 10-40 cm depth"),
    (12, "Deep Soil (40-100cm)", "Soil", 1.0, None, False, "Soil",
     "Deep root zone: soil moisture at 40-100 cm depth"),
]

LAYERS_LOCAL = [
    (1, "Surface", "Surface", 0.0, 1013.2, True, "Surface", "Surface level"),
    (2, "2m Air", "Air", 2.0, 1013.0, True, "Surface Boundary",
     "Standard air temperature height"),
    (3, "10m Wind", "Air", 10.0, 1012.0, True, "Surface Boundary",
     "Standard wind measurement height"),
    (4, "80m Air", "Air", 80.0, 1004.0, False, "Low Atmosphere",
     "Wind turbine hub height / low shearing"),
    (10, "850 hPa", "Air", 1500.0, 850.0, True, "Troposphere",
     "Top of planetary boundary layer approx"),
    (11, "500 hPa", "Air", 5500.0, 500.0, True, "Troposphere",
     "Middle troposphere / steering level"),
    (20, "Soil 6cm", "Soil", -0.06, None, True, "Topsoil", "Shallow root zone"),
    (21, "Soil 18cm", "Soil", -0.18, None, True, "Root Zone", "Middle root zone"),
    (22, "Soil 54cm", "Soil", -0.54, None, False, "Subsoil", "Deep soil moisture"),
]

# severity_id, severity_level, color_code, description
SEVERITY_BASE = [
    (1, "No Risk", "#00E676", "No significant weather hazards expected"),
    (2, "Low", "#FFEB3B", "Minor weather hazards: be aware of conditions"),
    (3, "Moderate", "#FF9800", "Moderate weather hazards: be prepared for disruptions"),
    (4, "High", "#F44336", "Severe weather: significant risk to life and property"),
    (5, "Extreme", "#9C27B0", "Extreme weather event: immediate danger, take shelter"),
]

SEVERITY_LOCAL = [
    (1, "Verde (Sin Riesgo)", "#00FF00",
     "No se espera que el tiempo cause impactos significativos."),
    (2, "Amarillo (Riesgo Bajo)", "#FFFF00",
     "Riesgo bajo para la población general, pero ciertas actividades pueden verse afectadas."),
    (3, "Naranja (Riesgo Importante)", "#FFA500",
     "Riesgo meteorológico importante con fenómenos inusuales y peligrosos."),
    (4, "Rojo (Riesgo Extremo)", "#FF0000",
     "Fenómenos excepcionalmente intensos con alto riesgo para la población."),
]

HEMISPHERES = ["North", "South"]
MEDIA = ["Surface", "Air", "Soil"]
RUN_STATUSES = ["running", "success", "failed"]

# ---------------------------------------------------------------------------
# Default stations
# station_id, station_name, province, altitude, latitude, longitude
# ---------------------------------------------------------------------------

DEFAULT_STATIONS = [
    ("3129", "MADRID, RETIRO", "MADRID", 667.0, 40.4115, -3.6784),
    ("0076", "BARCELONA, FABRA", "BARCELONA", 412.0, 41.4181, 2.1246),
    ("5530E", "SEVILLA, AEROPUERTO", "SEVILLA", 34.0, 37.4167, -5.8833),
    ("8416", "VALENCIA, AEROPUERTO", "VALENCIA", 69.0, 39.4833, -0.4833),
    ("1024E", "BILBAO, AEROPUERTO", "VIZCAYA", 42.0, 43.3000, -2.9167),
    ("6155A", "MALAGA, AEROPUERTO", "MALAGA", 5.0, 36.6667, -4.4833),
    ("1387", "ZARAGOZA, AEROPUERTO", "ZARAGOZA", 247.0, 41.6617, -1.0042),
    ("8178D", "ALICANTE, AEROPUERTO", "ALICANTE", 43.0, 38.2833, -0.5500),
    ("1111X", "SANTANDER, CMT", "CANTABRIA", 64.0, 43.4917, -3.7992),
    ("2539", "VALLADOLID", "VALLADOLID", 735.0, 41.6528, -4.7617),
    ("C447A", "PALMA DE MALLORCA", "ILLES BALEARS", 8.0, 39.5592, 2.7386),
    ("9434", "MURCIA, ALCANTARILLA", "MURCIA", 75.0, 37.9589, -1.2306),
    ("6001", "GRANADA, AEROPUERTO", "GRANADA", 567.0, 37.1867, -3.7772),
    ("9091O", "CORDOBA, AEROPUERTO", "CORDOBA", 90.0, 37.8417, -4.8500),
    ("9170", "TOLEDO", "TOLEDO", 515.0, 39.8817, -4.0489),
]

# ---------------------------------------------------------------------------
# Expected tasks of the extraction stage
# ---------------------------------------------------------------------------

EXTRACTION_DAG = "extraction_pipeline"
EXPECTED_TASKS = [
    "extract_openweather",
    "extract_openmeteo_daily",
    "extract_openmeteo_hourly",
    "extract_openmeteo_air_quality",
    "extract_openmeteo_pollen",
    "extract_openmeteo_marine",
    "extract_aemet_stations",
    "extract_aemet_daily_climatology",
]
BACKFILL_SOURCES = ["openweather", "openmeteo", "aemet"]

# ---------------------------------------------------------------------------
# Lake layout
# ---------------------------------------------------------------------------

BRONZE_PATHS = {
    "observation": "current/{date}/weather_{city}_{timestamp}.json",
    "daily": "forecast/daily/{date}/weather_daily_{timestamp}.json",
    "hourly": "forecast/hourly/{date}/weather_hourly_{timestamp}.json",
    "air_quality": "air_quality/{date}/air_quality_{timestamp}.json",
    "pollen": "pollen/{date}/pollen_{timestamp}.json",
    "marine": "marine/{date}/marine_{timestamp}.json",
    "stations": "stations/{date}/stations_{timestamp}.json",
    "station_day": "climatology/daily/{date}/daily_{station}_{timestamp}.json",
    "historical": "historical/{year}/{station}/historical_{start}_{end}_{timestamp}.json",
}

SILVER_PATHS = {
    "observation": "processed/{date}/weather_{date}.parquet",
    "daily": "forecast/daily/{date}/daily_forecast_{timestamp}.parquet",
    "hourly": "forecast/hourly/{date}/hourly_forecast_{timestamp}.parquet",
    "air_quality": "air_quality/{date}/air_quality_{timestamp}.parquet",
    "pollen": "pollen/{date}/pollen_{timestamp}.parquet",
    "marine": "marine/{date}/marine_{timestamp}.parquet",
    "stations": "stations/{date}/stations_{timestamp}.parquet",
    "station_day": "climatology/daily/{date}/daily_climatology_{timestamp}.parquet",
    "historical": "historical/{date}/historical_{timestamp}.parquet",
}
