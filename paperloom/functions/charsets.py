"""Unicode character classes for Java regular expressions.

Java reads ``\\w``, ``\\d``, ``\\s`` and ``\\b`` as ASCII unless told otherwise, so
every pattern of this package names its classes through these constants. The
bracket bodies are meant to be put inside ``[...]``.
"""

WORD = r"\p{L}\p{N}_"
SPACE = r"\s\x1c-\x1f\x85\p{Z}"
DIGIT = r"\p{Nd}"

NOT_AFTER_WORD = f"(?<![{WORD}])"
AFTER_WORD = f"(?<=[{WORD}])"
NOT_BEFORE_WORD = f"(?![{WORD}])"
WORD_EDGE = f"(?:(?<=[{WORD}])(?![{WORD}])|(?<![{WORD}])(?=[{WORD}]))"

# Code-point ranges treated as emoji. The last one is wide and also
# spans the CJK, kana and Hangul blocks.
EMOJI_RANGES = (
    (0x1F600, 0x1F64F),
    (0x1F300, 0x1F5FF),
    (0x1F680, 0x1F6FF),
    (0x1F1E0, 0x1F1FF),
    (0x2702, 0x27B0),
    (0x24C2, 0x1F251),
)
EMOJI = "".join(rf"\x{{{lo:X}}}-\x{{{hi:X}}}" for lo, hi in EMOJI_RANGES)
