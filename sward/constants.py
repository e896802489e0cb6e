"""Names and parameters shared by the whole package.

FIXED VALUES. Everything in this module must keep exactly these values for results to line up with the published
pipeline: column names, feature-name prefixes, thresholds and model settings.
"""

KEY = "image_path"
FOLD = "fold"
N_FOLDS = 5
SEED = 42

TARGETS = ("Dry_Clover_g", "Dry_Dead_g", "Dry_Green_g", "Dry_Total_g", "GDM_g")
TARGET_LABELS = {
    "Dry_Clover_g": "Dry Clover",
    "Dry_Dead_g": "Dry Dead Material",
    "Dry_Green_g": "Dry Green Vegetation",
    "Dry_Total_g": "Total Dry Biomass",
    "GDM_g": "Green Dry Matter",
}

CATEGORICAL_METADATA = ("State", "Species")
NUMERIC_METADATA = ("Pre_GSHH_NDVI", "Height_Ave_cm")
METADATA = CATEGORICAL_METADATA + NUMERIC_METADATA

IDENTIFIERS = ("image_path", "processed_image_path", "fold")
EMBEDDING_PREFIX = "cnn_"
VISUAL_PREFIXES = ("rgb_", "hsv_", "exg_", "vegetation_", "brown_", "hist_", "texture_", "edge_")

IMAGE_SIDE = 512
HIST_BINS = 16
EXG_THRESHOLD = 0.0
BROWN_HUE = (5, 35)
BROWN_SATURATION = (30, 180)
BROWN_MIN_VALUE = 60
GREY_LEVELS = 32
GLCM_DISTANCES = (1, 3, 5)
EDGE_LOW = 50
EDGE_HIGH = 150
HEAT_PERCENTILES = (0.02, 0.98)
HEAT_SIGMA = 7.0

RIDGE_ALPHA = 1.0
FOREST_TREES = 300
EXTRA_TREES = 500
BOOSTING = {"stepSize": 0.05, "maxIter": 300}
STOCHASTIC_BOOSTING = {"stepSize": 0.03, "maxIter": 500, "subsamplingRate": 0.8}
BATCH_SIZE = 32

PARITY_RTOL = 1e-5
PARITY_ATOL = 1e-6
TOP_IMPORTANCES = 25
BLEND_STEPS = 20
