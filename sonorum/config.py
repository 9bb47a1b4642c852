"""Constants of clip scoring. Results depend on them."""

SAMPLE_RATE = 16_000
MIN_SECONDS = 0.5
MAX_SECONDS = 10.0
MIN_SAMPLES = 8_000
MAX_SAMPLES = 160_000
MAX_UPLOAD_BYTES = 26_214_400
DEFAULT_TOP_K = 5
PADDED_SAMPLES = 480_000
N_MELS = 80
N_FRAMES = 3_000
BATCH_SIZE = 32
BATCH_WAIT_US = 10_000
RESPONSE_FORMATS = ("json", "verbose_json", "text")
DEFAULT_FORMAT = "json"
DEFAULT_LANGUAGE = "en"
DEFAULT_SUFFIX = ".wav"

#: Detail texts of rejects. Clients read them.
DETAIL_UNREADABLE = "Failed to read uploaded audio: %s"
DETAIL_EMPTY = "Audio upload is empty"
DETAIL_TOO_LARGE = "Audio upload exceeds the %d MB limit"
DETAIL_TOP_K = "top_k must be >= 1"
DETAIL_TOP_K_TEXT = "Invalid top_k value: %s"
DETAIL_UNDECODABLE = "Unable to decode the uploaded audio."
DETAIL_DURATION = "Audio duration must be between %s and %s seconds (received %.3f seconds)."
DETAIL_ERROR = "Inference failed"
DETAIL_PREPROCESSING = "Audio preprocessing failed: %s"
DETAIL_INFERENCE = "Model inference failed: %s"
DETAIL_NO_PREDICTIONS = "Model returned no intent predictions"
