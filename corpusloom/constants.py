"""Fixed values.

Everything in this module is a value that must equal the behaviour being
reproduced (sentinels, prompt texts, conversation templates).  They are
stated plainly, in their natural order, and used as literals in plans.
"""

# ---------------------------------------------------------------------------
# FIXED VALUES: sentinels and special token strings
# ---------------------------------------------------------------------------
IGNORE_INDEX = -100
IMAGE_TOKEN = "<image>"
PAD_TOKEN = "<pad>"
SFT_PAD_TOKEN = "[PAD]"
BOS_TOKEN = "<s>"
EOS_TOKEN = "</s>"

# Byte tokenizer layout (our own tokenizer, see functions/tokens.py):
#   0 <unk>, 1 <s>, 2 </s>, 3..258 = UTF-8 byte + 3, then added specials.
BYTE_OFFSET = 3
UNK_ID, BOS_ID, EOS_ID = 0, 1, 2
ADDED_SPECIALS = [
    "<image>",
    "<pad>",
    "[PAD]",
    "<|begin_of_text|>",
    "<|start_header_id|>",
    "<|end_header_id|>",
    "<|eot_id|>",
    "<|end_of_text|>",
]
SPECIAL_IDS = {"<unk>": 0, "<s>": 1, "</s>": 2}
SPECIAL_IDS.update({tok: 259 + i for i, tok in enumerate(ADDED_SPECIALS)})
IMAGE_TOKEN_ID = SPECIAL_IDS[IMAGE_TOKEN]
PAD_ID = SPECIAL_IDS[PAD_TOKEN]
SFT_PAD_ID = SPECIAL_IDS[SFT_PAD_TOKEN]
BYTE_VOCAB_SIZE = 259 + len(ADDED_SPECIALS)

# ---------------------------------------------------------------------------
# FIXED VALUES: instruction tuning prompt
# ---------------------------------------------------------------------------
SFT_PROMPT_PREFIX = (
    "Below is an instruction that describes a task. "
    "Write a response that appropriately completes the request.\n\n"
    "### Instruction:\n"
)
SFT_PROMPT_SUFFIX = "\n\n### Response: "
SFT_MAX_SEQ_LENGTH = 512

# ---------------------------------------------------------------------------
# FIXED VALUES: chat prompts
# ---------------------------------------------------------------------------
CHAT_DEFAULT_SYSTEM_PROMPT = "You are a kind and helpful assistant"
INFER_DEFAULT_SYSTEM_PROMPT = "You are a kind and helpful assistant. 你是一个善良且乐于助人的助手。"
CHAT_SYS_OPEN = "[INST] <<SYS>>\n"
CHAT_SYS_CLOSE = "\n<</SYS>>\n\n"
CHAT_INST_OPEN = "[INST] "
CHAT_INST_CLOSE = " [/INST]"
CHAT_INST_MARKER = "[/INST]"
ASSISTANT_MARKER = "ASSISTANT: "
CHAT_TOKEN_BUDGET = 1024
IMAGE_LENGTH_SURCHARGE = 128

# ---------------------------------------------------------------------------
# FIXED VALUES: image geometry
# ---------------------------------------------------------------------------
IMAGE_MAX_LEN = 1344
IMAGE_MIN_LEN = 672
IMAGE_RESIZE_SIDE = 336
IMAGE_PAD_BACKGROUND = (122, 116, 104)

# ---------------------------------------------------------------------------
# FIXED VALUES: conversation templates
# (name, system, roles, few-shot messages, offset, sep_style, sep, sep2, version)
# ---------------------------------------------------------------------------
_SYS_HUMAN = (
    "A chat between a curious human and an artificial intelligence assistant. "
    "The assistant gives helpful, detailed, and polite answers to the human's questions."
)
_SYS_USER = (
    "A chat between a curious user and an artificial intelligence assistant. "
    "The assistant gives helpful, detailed, and polite answers to the user's questions."
)
_SYS_LLAMA_2 = """You are a helpful, respectful and honest assistant. Always answer as helpfully as possible, while being safe.  Your answers should not include any harmful, unethical, racist, sexist, toxic, dangerous, or illegal content. Please ensure that your responses are socially unbiased and positive in nature.

If a question does not make any sense, or is not factually coherent, explain why instead of answering something not correct. If you don't know the answer to a question, please don't share false information."""
_SYS_LLAMA_3 = """You are a helpful, respectful and honest assistant. Always answer as helpfully as possible, while being safe.  Your answers should not include any harmful, unethical, racist, sexist, toxic, dangerous, or illegal content. Please ensure that your responses are socially unbiased and positive in nature.
If a question does not make any sense, or is not factually coherent, explain why instead of answering something not correct. If you don't know the answer to a question, please don't share false information."""
_SYS_LLAVA_LLAMA_2 = (
    "You are a helpful language and vision assistant. "
    "You are able to understand the visual content that the user provides, "
    "and assist the user with a variety of tasks using natural language."
)
_SYS_MPT = (
    "<|im_start|>system\n"
    "A conversation between a user and an LLM-based AI assistant. "
    "The assistant gives helpful and honest answers."
)
_SYS_MMTAG = (
    "A chat between a curious user and an artificial intelligence assistant. "
    "The assistant is able to understand the visual content that the user provides, "
    "and assist the user with a variety of tasks using natural language."
    "The visual content will be provided with the following format: <Image>visual content</Image>."
)
_SYS_CHATML_DIRECT = "<|im_start|>system\nAnswer the questions."

FEWSHOT_V0 = [
    ("Human", "What are the key differences between renewable and non-renewable energy sources?"),
    ("Assistant",
     "Renewable energy sources are those that can be replenished naturally in a relatively "
     "short amount of time, such as solar, wind, hydro, geothermal, and biomass. "
     "Non-renewable energy sources, on the other hand, are finite and will eventually be "
     "depleted, such as coal, oil, and natural gas. Here are some key differences between "
     "renewable and non-renewable energy sources:\n"
     "1. Availability: Renewable energy sources are virtually inexhaustible, while non-renewable "
     "energy sources are finite and will eventually run out.\n"
     "2. Environmental impact: Renewable energy sources have a much lower environmental impact "
     "than non-renewable sources, which can lead to air and water pollution, greenhouse gas emissions, "
     "and other negative effects.\n"
     "3. Cost: Renewable energy sources can be more expensive to initially set up, but they typically "
     "have lower operational costs than non-renewable sources.\n"
     "4. Reliability: Renewable energy sources are often more reliable and can be used in more remote "
     "locations than non-renewable sources.\n"
     "5. Flexibility: Renewable energy sources are often more flexible and can be adapted to different "
     "situations and needs, while non-renewable sources are more rigid and inflexible.\n"
     "6. Sustainability: Renewable energy sources are more sustainable over the long term, while "
     "non-renewable sources are not, and their depletion can lead to economic and social instability.\n"),
]

# Template objects: key -> (system, roles, messages, offset, sep_style, sep, sep2, version)
TEMPLATE_OBJECTS = {
    "vicuna_v0": (_SYS_HUMAN, ("Human", "Assistant"), FEWSHOT_V0, 2, "SINGLE", "###", None, "Unknown"),
    "vicuna_v1": (_SYS_USER, ("USER", "ASSISTANT"), [], 0, "TWO", " ", "</s>", "v1"),
    "llama_2": (_SYS_LLAMA_2, ("USER", "ASSISTANT"), [], 0, "LLAMA_2", "<s>", "</s>", "llama_v2"),
    "llama_3": (_SYS_LLAMA_3, ("USER", "ASSISTANT"), [], 0, "LLAMA_3", "<|begin_of_text|>",
                "<|end_of_text|>", "llama_v3"),
    "llava_llama_2": (_SYS_LLAVA_LLAMA_2, ("USER", "ASSISTANT"), [], 0, "LLAMA_2", "<s>", "</s>", "llama_v2"),
    "mpt": (_SYS_MPT, ("<|im_start|>user\n", "<|im_start|>assistant\n"), [], 0, "MPT", "<|im_end|>", None, "mpt"),
    "llava_plain": ("", ("", ""), [], 0, "PLAIN", "\n", None, "Unknown"),
    "llava_v0": (_SYS_HUMAN, ("Human", "Assistant"), [], 0, "SINGLE", "###", None, "Unknown"),
    "llava_v0_mmtag": (_SYS_MMTAG, ("Human", "Assistant"), [], 0, "SINGLE", "###", None, "v0_mmtag"),
    "llava_v1": (_SYS_HUMAN, ("USER", "ASSISTANT"), [], 0, "TWO", " ", "</s>", "v1"),
    "llava_v1_mmtag": (_SYS_MMTAG, ("USER", "ASSISTANT"), [], 0, "TWO", " ", "</s>", "v1_mmtag"),
    "mistral_instruct": ("", ("USER", "ASSISTANT"), [], 0, "LLAMA_2", "", "</s>", "llama_v2"),
    "chatml_direct": (_SYS_CHATML_DIRECT, ("<|im_start|>user\n", "<|im_start|>assistant\n"), [], 0, "MPT",
                      "<|im_end|>", None, "mpt"),
}

# Registered names -> template object key (17 names, 13 objects).
TEMPLATE_NAMES = {
    "default": "vicuna_v1",
    "v0": "vicuna_v0",
    "v1": "vicuna_v1",
    "vicuna_v1": "vicuna_v1",
    "llama_2": "llama_2",
    "llama_3": "llama_3",
    "mistral_instruct": "mistral_instruct",
    "chatml_direct": "chatml_direct",
    "mistral_direct": "chatml_direct",
    "plain": "llava_plain",
    "v0_plain": "llava_plain",
    "llava_v0": "llava_v0",
    "v0_mmtag": "llava_v0_mmtag",
    "llava_v1": "llava_v1",
    "v1_mmtag": "llava_v1_mmtag",
    "llava_llama_2": "llava_llama_2",
    "mpt": "mpt",
}

# Mask separators per preprocessing family (instruction/answer split string).
LLAMA_2_INST_SEP = "[/INST] "
LLAMA_3_INST_SEP = "<|eot_id|> "
