"""They must equal the reference's for equal results."""

# --- text cleaning ---------------------------------------------------------
HEADER_MARKER = "<|im_start|>"
# Removed one after the other, in this order.
MARKERS = [
    "<|im_end|>",
    "<|endoftext|>",
    "<|begin_of_text|>",
    "<|start_header_id|>",
    "<|end_header_id|>",
    "<|eot_id|>",
    "<|end_of_text|>",
]

# --- letter rule -----------------------------------------------------------
REQUIRED_LETTERS = "ўі"
FORBIDDEN_LETTERS = "щъи"
MIN_PROFILE_CHARS = 50
MAX_FORBIDDEN_RATIO = 0.01

# --- document layout -------------------------------------------------------
DEFAULT_SYSTEM = "Ты разумны памочнік."
CODE_SYSTEM = "You are a Python coding assistant."
DOC_OPEN = "<s>"
DOC_CLOSE = "</s>"
MIN_TEXT_CHARS = 300
MIN_CODE_CHARS = 20
MAX_CODE_CHARS = 8000

# --- mixing ----------------------------------------------------------------
UPSAMPLE_CHAT = 5
UPSAMPLE_BOOK = 3
CAP_WEB = 150_000
CAP_CODE = 30_000
CAP_SYNTHETIC = 70_000
MIX_BUFFER = 20_000

# --- tokenizer -------------------------------------------------------------
SAMPLE_BYTES = 100 * 1024 * 1024
SAMPLE_SLACK_BYTES = 5 * 1024 * 1024
VOCAB_SIZE = 32_000
MIN_PAIR_FREQ = 2
MAX_PIECE_CHARS = 32
UNK_ID, BOS_ID, EOS_ID = 0, 1, 2
WORD_SPECIALS = ["<unk>", "<s>", "</s>", "<|pad|>", "<|bos|>", "<|eos|>"]
LINE_SPECIALS = [
    "<|begin_of_text|>",
    "<|end_of_text|>",
    "<|start_header_id|>",
    "<|end_header_id|>",
    "<|eot_id|>",
    "<|finetune_right_pad_id|>",
    "<|python_tag|>",
]
WORD_MARK = "▁"

# --- chat inference --------------------------------------------------------
CHAT_PROMPT = (
    "<|begin_of_text|><|start_header_id|>user<|end_header_id|>\n\n",
    "<|eot_id|><|start_header_id|>assistant<|end_header_id|>\n\n",
)
ANSWER_DELIMITER = "assistant<|end_header_id|>\n\n"
ANSWER_ENDINGS = ["<|eot_id|>", "<|end_of_text|>"]

# --- token stream and telemetry --------------------------------------------
MAX_VOCAB = 65_536
CLUSTER_BYTES = 64 * 1024 * 1024
HISTORY_ROWS = 100
EMA_ALPHA = 0.05
REPORT_EVERY = 10
TEXT_EXTENSIONS = ["txt", "json", "md", "csv", "py"]

# Characters Python's str.strip() and str.split() treat as white space.
WHITESPACE = "".join(
    map(
        chr,
        [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680]
        + [*range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000],
    )
)
# The same set as a character class that java.util.regex and RE2 both read.
WHITESPACE_CLASS = (
    r"[\t-\r\x1c-\x20\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
