"""Code dictionaries and scale constants of the supported datasets.

Fixed values: codes, texts and maxima belong to the data formats and are stated
as they are.
"""

# Page classification: 0/1 label.
PAGE_KIND = {0: "暂时性网页（ephemeral）", 1: "长青网页（evergreen）"}

# Hourly rentals: coded columns.
SEASON = {1: "春", 2: "夏", 3: "秋", 4: "冬"}
HOLIDAY = {0: "非假日", 1: "假日"}
WEEKDAY = {0: "一", 1: "二", 2: "三", 3: "四", 4: "五", 5: "六", 6: "日"}
WORKINGDAY = {0: "非工作日", 1: "工作日"}
WEATHER = {1: "晴", 2: "阴", 3: "小雨", 4: "大雨"}

# Hourly rentals: the maximum each measured column was divided by.
RENTAL_MAXIMA = {"temp": 41, "atemp": 50, "hum": 100, "windspeed": 67}

# Terrain cover: display names of the first measurements.
COVER_NAMES = {
    "f0": "海拔", "f1": "方位", "f2": "斜率", "f3": "垂直距离", "f4": "水平距离", "f5": "阴影",
}
