"""Fixed values that results must agree on.

These are stated once, plainly, and every operator reads them from here.
"""

# ---- fixed values -----------------------------------------------------------
# Document delimiter used by corpus files and reserved as the last vocabulary id.
EOT = "<|endoftext|>"
# Separator written after every document by the corpus writer.
DOC_SUFFIX = "\n\n" + EOT + "\n\n"
# Raw byte ids occupy 0..255; merges start at 256; EOT is vocab_size - 1.
BYTE_VOCAB = 256
# Smallest trainable vocabulary: 256 bytes + at least one merge + EOT.
MIN_TRAIN_VOCAB = 258
# Largest id that compact (16-bit) token storage accepts, exclusive.
COMPACT_ID_LIMIT = 65536
# GPT-2 pretokenizer split pattern, as published (Python `regex` syntax).
GPT2_PATTERN_PY = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
# Softmax temperature floor and renormalisation epsilon of nucleus sampling.
MIN_TEMPERATURE = 1e-6
TOP_P_EPS = 1e-12
# ---- end of fixed values ----------------------------------------------------

# Whitespace classes in Java regex syntax (checked equal, code point by code
# point, to the Python classes they stand for):
#   WS_STRIP: what `str.strip()` and `re`'s `\s` treat as whitespace
#   WS_PRETOK: what the `regex` module's `\s` matches in the pretokenizer
WS_STRIP = r"[\t-\r\x{1c}-\x{20}\x{85}\p{Z}]"
WS_PRETOK = r"[\t-\r \x{85}\p{Z}]"
# The characters of WS_STRIP one by one, for trimming without a regex.
WS_CHARS = "".join(chr(c) for c in (
    *range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000))
_WS_BODY = r"\t-\r \x{85}\p{Z}"

# The GPT-2 pattern rewritten for java.util.regex: `\s` → WS_PRETOK, `\S` → its
# complement.  Java supports the lookahead, so the structure is unchanged.
GPT2_PATTERN_JAVA = (
    r"'s|'t|'re|'ve|'m|'ll|'d"
    r"| ?\p{L}+| ?\p{N}+"
    rf"| ?[^{_WS_BODY}\p{{L}}\p{{N}}]+"
    rf"|[{_WS_BODY}]+(?![^{_WS_BODY}])"
    rf"|[{_WS_BODY}]+"
)

# Surrogate code points cannot live in a Spark string; merge ids at or above
# 0xD800 are shifted past the surrogate block when held as characters.
SURROGATE_START = 0xD800
SURROGATE_SHIFT = 0x800
