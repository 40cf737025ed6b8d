from talkgrain.functions.text import ratio, word_count, words

__all__ = ["ratio", "word_count", "words"]
