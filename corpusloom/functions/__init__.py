"""Column-expression helpers (text rules, byte tokenizer)."""

from corpusloom.functions.text import (  # noqa: F401
    py_strip,
    regex_quote,
    rfind_slice,
    substring_after_last,
    text_lines,
    word_count,
    words,
)
from corpusloom.functions.tokens import (  # noqa: F401
    byte_ids,
    decode_bytes,
    encode_bytes,
    encode_with_specials,
    ids_to_string,
    n_tokens,
)
