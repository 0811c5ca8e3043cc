"""Rows that every operator must take: used as an input with clashing extra columns."""

DOC = "doc_id long, text string, lang string, source string, n_chars long"
#: Names that the operators use inside; as extra columns of an input they must not matter.
CLASHES = ("__id", "__text", "row", "ids", "r", "p", "class", "n", "size", "bucket", "copies", "order", "target", "bits",
           "place", "key1", "key2", "keep_id", "text_hash", "score", "rank", "html_", "field", "hashes", "host", "least")


def odd_rows():
    """Nulls in every column, empty and blank texts, repeats of whole rows and of ids, ties, a long text."""
    words = "one two three four five six seven eight nine ten eleven twelve"
    long = " ".join(f"w{i % 977}x{i % 31}" for i in range(60_000))
    return [
        (1, words, "en", "a", 1), (2, words, "en", "b", 2), (2, words, "en", "b", 2), (3, words + "  ", None, None, None),
        (4, None, "en", "a", 0), (5, "", "en", "a", 0), (6, " \t\n", None, "b", None), (None, words, "en", None, 3),
        (None, "quite another text without an id at all", "en", "a", 3), (None, None, None, None, None),
        (7, long, "en", "c", 1), (8, long + " end", "en", "c", 1), (9, "1234 5678 !!", "en", "a", 1),
        (2, "the same id with another text, which is also a document of its own", "en", "b", 9),
        (10, "été déjà vu ça où là naïve cœur", "fr", "b", 1), (11, "ÉTÉ déjà vu ça où là naïve cœur", "fr", "b", 1),
    ]
