"""Porter's suffix stripping (M. F. Porter, 1980), as full-text indexes with the ``porter`` tokenizer apply it."""

from __future__ import annotations

from functools import lru_cache

# The rules of steps 2, 3 and 4.
STEP2 = [("ational", "ate"), ("tional", "tion"), ("enci", "ence"), ("anci", "ance"), ("izer", "ize"), ("logi", "log"), ("bli", "ble"), ("alli", "al"), ("entli", "ent"), ("eli", "e"), ("ousli", "ous"), ("ization", "ize"), ("ation", "ate"), ("ator", "ate"), ("alism", "al"), ("iveness", "ive"), ("fulness", "ful"), ("ousness", "ous"), ("aliti", "al"), ("iviti", "ive"), ("biliti", "ble")]
STEP3 = [("icate", "ic"), ("ative", ""), ("alize", "al"), ("iciti", "ic"), ("ical", "ic"), ("ful", ""), ("ness", "")]
STEP4 = "al ance ence er ic able ible ant ement ment ent ion ou ism ate iti ous ive ize".split()


def _consonant(w: str, i: int) -> bool:
    return w[i] not in "aeiou" and (w[i] != "y" or i == 0 or not _consonant(w, i - 1))


def _measure(w: str) -> int:
    kinds = [_consonant(w, i) for i in range(len(w))]
    return sum(not a and b for a, b in zip(kinds, kinds[1:]))


def _vowel(w: str) -> bool:
    return any(not _consonant(w, i) for i in range(len(w)))


def _double(w: str) -> bool:
    return len(w) > 1 and w[-1] == w[-2] and _consonant(w, len(w) - 1)


def _cvc(w: str) -> bool:
    n = len(w)
    return n > 2 and _consonant(w, n - 1) and not _consonant(w, n - 2) and _consonant(w, n - 3) and w[-1] not in "wxy"


def _replace(w: str, rules: list[tuple[str, str]], least: int) -> str:
    for ending, put in sorted(rules, key=lambda r: -len(r[0])):
        if w.endswith(ending):
            head = w[: -len(ending)]
            return head + put if _measure(head) >= least else w
    return w


@lru_cache(maxsize=1 << 18)
def stem(word: str) -> str:
    """The stem of a lower-case word; words of fewer than three letters, or longer than 64 or with other signs, stay."""
    if not 2 < len(word) < 65 or not all("a" <= c <= "z" for c in word):
        return word
    w = word
    if w.endswith("s"):
        w = w[:-2] if w.endswith(("sses", "ies")) else w if w.endswith("ss") else w[:-1]
    if w.endswith("eed"):
        w = w[:-1] if _measure(w[:-3]) > 0 else w
    else:
        for ending in ("ed", "ing"):
            if w.endswith(ending) and _vowel(w[: -len(ending)]):
                w = w[: -len(ending)]
                if w.endswith(("at", "bl", "iz")):
                    w += "e"
                elif _double(w) and w[-1] not in "lsz":
                    w = w[:-1]
                elif _measure(w) == 1 and _cvc(w):
                    w += "e"
                break
    if w.endswith("y") and _vowel(w[:-1]):
        w = w[:-1] + "i"
    w = _replace(w, STEP2, 1)
    w = _replace(w, STEP3, 1)
    for ending in sorted(STEP4, key=len, reverse=True):
        if w.endswith(ending):
            head = w[: -len(ending)]
            if _measure(head) > 1 and (ending != "ion" or head[-1:] in ("s", "t")):
                w = head
            break
    if w.endswith("e") and (_measure(w[:-1]) > 1 or (_measure(w[:-1]) == 1 and not _cvc(w[:-1]))):
        w = w[:-1]
    if w.endswith("ll") and _measure(w) > 1:
        w = w[:-1]
    return w
