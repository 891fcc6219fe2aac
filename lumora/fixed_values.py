"""Fixed values.

Everything in this file must equal published values for results to agree:
word lists, lookup tables and constants, stated as they are.
"""

# --- curation: category and the phrase it is searched with, in id order -----
CATEGORY_PLAN = [
    ("dog", "dog portrait"),
    ("cat", "cat portrait"),
    ("beach", "tropical beach ocean"),
    ("mountains", "mountain landscape"),
    ("city", "city skyline night"),
    ("food", "pizza plate food"),
    ("coffee", "cup of coffee"),
    ("flowers", "flower blossom macro"),
    ("car", "vintage car"),
    ("bicycle", "bicycle street"),
    ("sunset", "sunset sky clouds"),
    ("forest", "forest path trees"),
]
ITEMS_PER_CATEGORY = 3
HITS_PER_CATEGORY = 20
MIN_PAYLOAD_BYTES = 3000
PAYLOAD_MIME_PATTERN = r"(?i)image/(jpe?g|png|webp)"
TITLE_LENGTH = 120
UNTITLED = "Untitled"
UNKNOWN_CREATOR = "Unknown"
FILE_NAME_FORMAT = "gallery/img/%03d.jpg"

# --- evaluation: category and its prompt, in report order -------------------
EVALUATION_PROMPTS = [
    ("dog", "a photo of a dog"),
    ("cat", "a photo of a cat"),
    ("beach", "a photo of a tropical beach"),
    ("mountains", "a photo of mountains"),
    ("city", "a photo of a city skyline at night"),
    ("food", "a photo of a pizza"),
    ("coffee", "a photo of a cup of coffee"),
    ("flowers", "a photo of a flower"),
    ("car", "a photo of a car"),
    ("bicycle", "a photo of a bicycle"),
    ("sunset", "a photo of a sunset"),
    ("forest", "a photo of a forest"),
]
PRECISION_CUTOFFS = (1, 3, 5)
TOP_IDS = 5

# --- zero-shot tagging: vocabulary (its order breaks ties) -------------------
LABEL_VOCABULARY = [
    "dog", "cat", "bird", "horse", "person", "child", "crowd",
    "beach", "ocean", "mountain", "forest", "desert", "waterfall", "lake",
    "city", "skyline", "building", "street", "bridge", "road",
    "car", "bicycle", "motorcycle", "train", "boat", "airplane",
    "food", "pizza", "coffee", "cake", "fruit",
    "flower", "tree", "grass", "snow", "rain", "fog",
    "sunset", "sunrise", "night", "daytime",
    "indoor", "outdoor", "close-up", "aerial view",
    "black and white", "colorful", "vintage",
]
PROMPT_PREFIX = "a photo of "
SOFTMAX_TEMPERATURE = 25.0
TAGS_PER_ITEM = 8

# --- legend colours ---------------------------------------------------------
CATEGORY_COLOURS = {
    "dog": "#f97316",
    "cat": "#f43f5e",
    "beach": "#22d3ee",
    "mountains": "#a3e635",
    "city": "#818cf8",
    "food": "#fbbf24",
    "coffee": "#d97706",
    "flowers": "#ec4899",
    "car": "#38bdf8",
    "bicycle": "#2dd4bf",
    "sunset": "#fb7185",
    "forest": "#34d399",
    "upload": "#ffffff",
}
DEFAULT_COLOUR = "#94a3b8"

# --- vectors, relevance shading and the 2-D map -----------------------------
STORED_DECIMALS = 5
DIM_BELOW = 0.45
CANVAS_WIDTH, CANVAS_HEIGHT, CANVAS_PADDING = 520.0, 380.0, 26.0
POWER_ITERATIONS = 60
SEED_FREQUENCY, SEED_AMPLITUDE = 12.9898, 43758.5453

# --- arrivals and attribution -----------------------------------------------
UPLOAD_CATEGORY = "upload"
UPLOAD_CREDIT = "Uploaded image"
CREDIT_SERVICE = "Openverse"
