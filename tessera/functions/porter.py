"""Porter's suffix-stripping stemmer with the customary extensions.

M. F. Porter, "An algorithm for suffix stripping", Program 14(3), 1980, and the
changes that ROUGE scorers apply to it: a list of irregular forms, short words in
``-ies`` and ``-ied``, ``y`` only after a consonant, and some step 2 suffixes.
Small per-token helper used inside the ROUGE-L Arrow UDF; it holds no state.
"""

from __future__ import annotations

from functools import lru_cache

_VOWELS = frozenset("aeiou")


def _is_cons(w: str, i: int) -> bool:
    ch = w[i]
    if ch in _VOWELS:
        return False
    if ch == "y":
        return i == 0 or not _is_cons(w, i - 1)
    return True


def _measure(stem: str) -> int:
    """m in [C](VC)^m[V]."""
    m, i, n = 0, 0, len(stem)
    while i < n and _is_cons(stem, i):
        i += 1
    while i < n:
        while i < n and not _is_cons(stem, i):
            i += 1
        if i >= n:
            break
        while i < n and _is_cons(stem, i):
            i += 1
        m += 1
    return m


def _has_vowel(stem: str) -> bool:
    return any(not _is_cons(stem, i) for i in range(len(stem)))


def _double_cons(w: str) -> bool:
    return len(w) >= 2 and w[-1] == w[-2] and _is_cons(w, len(w) - 1)


def _cvc(w: str) -> bool:
    if len(w) == 2:
        return not _is_cons(w, 0) and _is_cons(w, 1)
    if len(w) < 3:
        return False
    i = len(w) - 1
    return (_is_cons(w, i - 2) and not _is_cons(w, i - 1) and _is_cons(w, i)
            and w[i] not in "wxy")


def _replace(w: str, suffix: str, repl: str, min_m: int) -> tuple[str, bool]:
    """If ``w`` ends with suffix: replace when m(stem) > min_m. Returns (word, matched)."""
    if w.endswith(suffix):
        stem = w[: len(w) - len(suffix)]
        if _measure(stem) > min_m:
            return stem + repl, True
        return w, True
    return w, False


# Irregular forms and their stems.
_IRREGULAR = {"sky": "sky", "skies": "sky", "dying": "die", "lying": "lie", "tying": "tie", "news": "news",
              "inning": "inning", "innings": "inning", "outing": "outing", "outings": "outing", "canning": "canning",
              "cannings": "canning", "howe": "howe", "proceed": "proceed", "exceed": "exceed", "succeed": "succeed"}
# The algorithm's suffix tables (steps 2, 3, 4).
_STEP2 = (("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"),
          ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"),
          ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"),
          ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble"),
          ("fulli", "ful"))
_STEP3 = (("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"),
          ("ful", ""), ("ness", ""))
_STEP4 = ("al", "ance", "ence", "er", "ic", "able", "ible", "ant", "ement", "ment", "ent", "ion",
          "ou", "ism", "ate", "iti", "ous", "ive", "ize")


def _step2(w: str) -> str:
    if w.endswith("alli") and _measure(w[:-4]) > 0:
        return _step2(w[:-2])  # -ally: what is left may hold a further suffix
    for suf, rep in _STEP2:
        w, hit = _replace(w, suf, rep, 0)
        if hit:
            return w
    if w.endswith("logi") and _measure(w[:-3]) > 0:
        return w[:-1]
    return w


@lru_cache(maxsize=262144)
def stem(word: str) -> str:
    w = word
    if w in _IRREGULAR:
        return _IRREGULAR[w]
    if len(w) <= 2:
        return w
    # step 1a
    if w.endswith("sses"):
        w = w[:-2]
    elif w.endswith("ies"):
        w = w[:-1] if len(w) == 4 else w[:-2]
    elif w.endswith("ss"):
        pass
    elif w.endswith("s"):
        w = w[:-1]
    # step 1b
    extra = False
    if w.endswith("ied"):
        w = w[:-1] if len(w) == 4 else w[:-2]
    elif w.endswith("eed"):
        if _measure(w[:-3]) > 0:
            w = w[:-1]
    elif w.endswith("ed") and _has_vowel(w[:-2]):
        w, extra = w[:-2], True
    elif w.endswith("ing") and _has_vowel(w[:-3]):
        w, extra = w[:-3], True
    if extra:
        if w.endswith(("at", "bl", "iz")):
            w += "e"
        elif _double_cons(w) and w[-1] not in "lsz":
            w = w[:-1]
        elif _measure(w) == 1 and _cvc(w):
            w += "e"
    # step 1c
    if w.endswith("y") and len(w) > 2 and _is_cons(w, len(w) - 2):
        w = w[:-1] + "i"
    w = _step2(w)
    # step 3
    for suf, rep in _STEP3:
        w, hit = _replace(w, suf, rep, 0)
        if hit:
            break
    # step 4
    for suf in _STEP4:
        if w.endswith(suf):
            stem_ = w[: len(w) - len(suf)]
            if suf == "ion":
                if _measure(stem_) > 1 and stem_ and stem_[-1] in "st":
                    w = stem_
            elif _measure(stem_) > 1:
                w = stem_
            break
    # step 5a
    if w.endswith("e"):
        stem_ = w[:-1]
        m = _measure(stem_)
        if m > 1 or (m == 1 and not _cvc(stem_)):
            w = stem_
    # step 5b
    if _measure(w) > 1 and _double_cons(w) and w.endswith("l"):
        w = w[:-1]
    return w
