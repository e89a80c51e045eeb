from larder.functions.columns import column, present
from larder.functions.text import words

__all__ = ["column", "present", "words"]
