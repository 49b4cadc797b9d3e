"""Fixed values.

Labels, limits and constants that results must agree on, stated as they are.
"""

# Gender spellings (after trim and upper-casing) and the canonical labels.
GENDER_SPELLINGS = {"Female": ("FEMALE", "F"), "Male": ("MALE", "M")}
GENDER_UNKNOWN = "Unknown"
GENDER_CODES = {"Female": 0, "Male": 1}
GENDER_OTHER_CODE = -1

# Plausible ages.
AGE_MIN = 0
AGE_MAX = 120

# Application outcomes.
ACCEPTED = "TakeUp"
DECLINED = "Declined"

# Customer segments.
BORROWER = "Existing Borrower"
PROSPECT = "Deposit-Only Prospect"

# Markers for "no history".
NO_HISTORY_RATE = -1.0
NEVER_DAYS = 9999

# Life-stage segments: the label of an age band, by side of the median income.
LIFE_STAGE_LABELS = {
    "lower third": {"above": "Young_HighIncome", "other": "Young_LowIncome"},
    "middle third": {"above": "MidAge_HighIncome", "other": "MidAge_LowIncome"},
    "upper third": {"above": "Senior_Stable", "other": "Senior_Stable"},
}
# The label where age is not known.
LIFE_STAGE_DEFAULT = "MidAge_LowIncome"

# Action quadrants: labels, limits and, in order of precedence, what must hold for each.
QUADRANT_IDEAL = "Segment_A_Ideal_Target"
QUADRANT_RISK = "Segment_B_High_Risk"
QUADRANT_UNTAPPED = "Segment_C_Untapped_Potential"
QUADRANT_OTHER = "Segment_D_Seasonal_Borrower"
VOLATILITY_LIMIT = 1.2
LOW_BALANCE_LIMIT = 5
POOR_RECORD_BELOW = 0.70
GOOD_RECORD_FROM = 0.90
QUADRANT_RULES = (
    (QUADRANT_UNTAPPED, (("total_applications", "=", 0), ("income", ">=", "income_median"))),
    (QUADRANT_RISK, (("balance_volatility_index", ">", VOLATILITY_LIMIT),)),
    (QUADRANT_RISK, (("low_balance_frequency", ">", LOW_BALANCE_LIMIT),)),
    (QUADRANT_RISK, (("total_applications", ">", 0), ("acceptance_rate", "<", POOR_RECORD_BELOW))),
    (
        QUADRANT_IDEAL,
        (
            ("income", ">=", "income_median"),
            ("balance_volatility_index", "<=", VOLATILITY_LIMIT),
            ("net_cash_flow", ">", 0),
            ("acceptance_rate", ">=", GOOD_RECORD_FROM),
        ),
    ),
)

# Placeholder numbers looked for in money columns.
SENTINELS = (9999, 99999, 999999, -1)

# Fence width in interquartile ranges.
FENCE_WIDTH = 1.5

# Quantile levels.
TAIL_LEVELS = (0.01, 0.99)
LOW_BALANCE_LEVEL = 0.10
AGE_TERTILE_LEVELS = (0.33, 0.66)
THIN_HISTORY_LEVEL = 0.05

# Age bands: inclusive upper bound and label, then the open band.
AGE_BANDS = ((25, "<=25"), (35, "26-35"), (50, "36-50"), (65, "51-65"))
AGE_BAND_OPEN = "65+"

# Population stability: bins, share given to an empty bin, class limits.
PSI_BINS = 10
PSI_EMPTY_SHARE = 1e-4
PSI_STABLE_BELOW = 0.10
PSI_MODERATE_TO = 0.25

# Significance level of the distribution tests.
SIGNIFICANCE = 0.05

# Feature selection.
MIN_VARIANCE = 0.01
MAX_VIF = 10.0

# Classifier.
REG_PARAM = 0.1
ELASTIC_NET = 0.0
MAX_ITER = 100
TEST_SHARE = 0.2
SEED = 42
ABLATION_LIMIT = 0.01
FOUR_FIFTHS = 0.80

# Chart tables.
HISTOGRAM_BINS = 30
TOP_ROWS = 15
CONFUSION_LABELS = {
    "true_negative": "Correctly Blocked",
    "false_positive": "Wasted Promo",
    "false_negative": "Missed Target",
    "true_positive": "Correct Conversion",
}

# Upper bounds of the score histogram; +infinity is implied.
SCORE_BOUNDS = (0.0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1.0)
# Smallest denominator of a ratio of two event counts.
RATIO_FLOOR = 1e-9
