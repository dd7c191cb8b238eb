"""Text helpers for the keyword-mention operator."""

# A word is a run of Unicode letters or digits; matching is case-insensitive.
WORD_SPLIT = r"[^\p{L}\p{N}]+"
