"""Values that results depend on, stated once."""

# Patterns and literals that must stay as they are for equal results.
TAG = r"<[^>]+>"
WHITESPACE = (
    r"[\x{09}-\x{0D}\x{1C}-\x{20}[\x{85}-\x{3000}&&"
    r"[\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]]]"
)
WHITESPACE_CHARACTERS = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006"
    "\u2007\u2008\u2009\u200a\u2028\u2029\u202f\u205f\u3000"
)
PART_SEPARATOR = "\n\n"
PREVIEW_CHARS = 100
PREVIEW_SUFFIX = "..."
ANSWER_MARK = "Answer:"
PROMPT_HEAD = "Context information:\n"
PROMPT_QUESTION = "\n\nQuestion: "
PROMPT_TAIL = "\n\nAnswer:"
DONT_KNOW = r"don't know|cannot answer|insufficient information"
SERVER_ERROR = r"^5..$"
SPLIT_RATIOS = {"train": 0.8, "validation": 0.1, "test": 0.1}
SPLIT_SEED = 42
BUILD_MAX_LENGTH = 128
ENCODE_MAX_LENGTH = 512
SEARCH_K = 5
CONTEXT_K = 3
TOP_QUESTIONS = 10
RATE_WINDOW_MINUTES = 5
ERROR_RATIO_LIMIT = 0.05
P95_LIMIT_SECONDS = 2.0
GPU_UTILISATION_LIMIT = 90.0
DISK_FREE_PERCENT_LIMIT = 10.0
GPU_HOLD_MINUTES = 15
DISK_HOLD_MINUTES = 5
NO_MATCH_REASON = "Response did not match expected pattern"
BAD_STATUS_REASON = "API returned status code "

# Our own choices, where nothing above prescribes a value.
WORD_OR_PUNCTUATION = r"[\p{L}\p{M}\p{N}_]+|[^\p{L}\p{M}\p{N}_\s]"
SPECIAL_TOKENS = ("<pad>", "<unk>", "<s>", "</s>")
PAD_ID, UNK_ID, BOS_ID, EOS_ID = range(4)
VOCABULARY_SIZE = 32_000
LATENCY_BOUNDS = (0.05, 0.1, 0.25, 0.5, 1.0, 2.0, 2.5, 5.0, 10.0)
TOKEN_BOUNDS = (5, 10, 25, 50, 100, 250, 500)
PASSAGE_TOKENS = 256
PASSAGE_OVERLAP = 32
FALLBACK_CONTEXT = "No relevant document was found."
EMAIL = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE = r"\+?[0-9]{1,4}[-. ][0-9]{2,4}[-. ][0-9]{3,4}([-. ][0-9]{2,4})?"
NUMBER_RUN = r"[0-9]{6,}"
