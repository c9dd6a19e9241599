"""Limits, texts and defaults that results depend on."""

# Fixed values -- reading validity (exclusive lower, inclusive upper bound).
SPEED_MIN_EXCLUSIVE = 0.0
SPEED_MAX_INCLUSIVE = 120.0

# Fixed values -- strict outlier rule on the network mean (limits are exclusive).
IQR_FACTOR = 2.5
HARD_LOW_EXCLUSIVE = 5.0
HARD_HIGH_EXCLUSIVE = 110.0

# Fixed values -- road state names by ascending mean speed.
STATE_CONGESTED = "Tắc nghẽn"
STATE_NORMAL = "Bình thường"
STATE_FREE = "Thông thoáng"

# Fixed values -- green-time ladder: (minimum probability, extension %, level).
LADDER = (
    (0.7, 30, "critical"),
    (0.5, 20, "high"),
    (0.3, 10, "moderate"),
)
LADDER_FLOOR = (-10, "low")
LADDER_UNKNOWN = (0, "unknown")

# Fixed values -- strategy texts; {} takes the percentage.
TEXT_EXTEND = "Kéo dài pha xanh thêm {}%"
TEXT_SHORTEN = "Rút ngắn pha xanh {}%"
TEXT_SHORTEN_SERVING = "Rút ngắn pha xanh {}% để ưu tiên hướng khác"
TEXT_UNKNOWN = "Giữ nguyên chu kỳ đèn hiện tại"

# Fixed values -- scoring service texts.
STATUS_RISK = "Có nguy cơ tắc nghẽn"
STATUS_CLEAR = "Thông thoáng"
ERROR_AVG_SPEED = "Thiếu hoặc sai định dạng trường avg_speed."

# Fixed values -- model features, grid and seeds.
FEATURES = ("avg_speed", "hour", "weekday", "std_speed_hour")
REG_PARAMS = (0.0, 0.01, 0.05)
ELASTIC_NET_PARAMS = (0.0, 0.3)
SEED = 42
DECISION_THRESHOLD = 0.5

# Fixed values -- how states are fitted.
KMEANS_ITERATIONS, KMEANS_TOLERANCE, KMEANS_INIT_STEPS = 120, 1e-4, 5

# Fixed values -- when and how the model is trained.
MIN_TRAIN, MIN_TEST, FOLDS, MODEL_ITERATIONS = 10, 5, 2, 100

# Fixed values -- published coefficients of one trained model (standardised inputs).
PUBLISHED_COEFFICIENTS = {
    "avg_speed": -5.250931751113657,
    "hour": 0.5153755252903305,
    "weekday": 0.08436116202529612,
    "std_speed_hour": 0.031320813122919976,
}
# The published run gives no intercept; scoring with fixed coefficients uses this one.
DEFAULT_INTERCEPT = -0.5

# Fixed values -- names of the slot reports and their columns, as dashboards read them: column -> measure of the cube.
REPORT_COLUMNS = {
    "overview": {"total_rows": "count", "avg_speed": "avg_speed", "avg_prob_congestion": "avg_prob",
                 "congestion_ratio": "congestion_ratio", "start_time": "start_time", "end_time": "end_time"},
    "cluster_distribution": {"count": "count", "avg_speed": "avg_speed", "avg_prob_congestion": "avg_prob"},
    "congestion_summary": {"count": "count", "avg_prob": "avg_prob", "avg_speed": "avg_speed"},
    "hourly_summary": {"avg_speed": "avg_speed", "avg_prob_congestion": "avg_prob", "std_speed_hour": "std_speed", "count": "count"},
    "weekday_summary": {"avg_speed": "avg_speed", "avg_prob_congestion": "avg_prob", "std_speed_weekday": "std_speed", "count": "count"},
    "top_congestion": {"avg_prob": "avg_prob", "count": "count"},
    "histogram_avg_speed": {"count": "count", "bin_upper": "bin_upper"},
    "daily_avg_speed": {"avg_speed": "avg_speed", "std_speed": "std_speed", "avg_prob_congestion": "avg_prob", "count": "count"},
    "weekday_hour_heatmap": {"avg_speed": "avg_speed", "avg_prob_congestion": "avg_prob", "count": "count"},
}
TOP_CONGESTION_ROWS = 20

# Fixed values -- defaults of the reports and of the hourly spread lookup.
HISTOGRAM_WIDTH = 5.0
STD_FALLBACK = 5.0

# Fixed values -- accepted time formats, tried in this order after ISO text.
TIME_FORMATS = ("M/d/yyyy H:mm", "M/d/yyyy H:mm:ss", "M/d/yyyy")
