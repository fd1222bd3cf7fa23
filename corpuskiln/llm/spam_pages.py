"""Keyword-stuffed pages, link lists and tag lists, by perplexity under class models of prose, lists and data.

Method. A page becomes a sequence of about sixty classes: function words by their part of speech and language, other words
by shape and ending, numbers, links, marks. A trigram model over classes is counted on all pages that read as prose, and
every page is scored in blocks under it. How block perplexity is spread over the prose pages gives the normal range; a page
whose blocks mostly lie outside it (too high: no grammar; too low: one pattern repeated) is a candidate.

Code, logs, raw data and prose in odd spelling are abnormal but no spam. So the abnormal blocks are scored once more, under three
bigram models over the same classes, each told apart by whether the word was on the page before: of prose, of lists and of data.
The list and the data model are counted on candidates that read clearly as the one or the other (``reads_as``), from the whole
input. A candidate is spam if its perplexity is lowest under the list model; what it was counted as, if at all, plays no part.

Everything the driver holds is bounded by the number of classes: at most classes**3 counts and a fixed histogram.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskiln.session import ship_package, spread, stage_table

# Function words by language and part of speech.
FUNCTION_WORDS = {
    "en_det": "the a an this these those our his her their its my your no any some each",
    "en_prep": "of to in for with by on at from about into over through before after near around despite since without under between across during along until off out up behind within against",
    "en_conj": "and or but that as if than so because while when whenever although though where how which who what",
    "en_aux": "is was are be have had were has been will would can could may do did should must not",
    "en_pron": "it he they you she we i him them us there nothing one all more most also only then now just even first",
    "es_det": "el la los las un una unos unas este esta su sus nuestro nuestra lo al del",
    "es_prep": "de en por con para sin sobre entre hasta desde según durante cerca antes después",
    "es_other": "y o que se es más pero como le fue ser ha son cuando porque todo ya muy",
    "de_det": "der die das den dem des ein eine einen einem einer eines unser unsere",
    "de_prep": "mit von zu zum zur im am auf für bei nach aus vor über um ohne zwischen unter nahe trotz seit durch gegen bis während",
    "de_other": "und oder ist sind war nicht sich auch wie wenn dass er sie es wir ich",
    "fr_det": "les une des du au aux ce cette son ses notre l d",
    "fr_prep": "dans pour sur avec par avant sous pendant malgré chez selon",
    "fr_other": "et ou est sont pas qui plus très il elle nous vous ne",
}
CHINESE_FUNCTION = "的了在是和与把被从到对就都也很不这那我们之"
# Marks with a class of their own (several marks may share one).
MARKS = {m: k for k, ms in {".": ".。", "!": "!！", "?": "?？", ",": ",，、", ";": ";；", ":": ":：", "-": "-—–_", "/": "/", "|": "|·", "#": "#", "*": "*•", "(": "(（", ")": ")）", "[": "[", "]": "]", "{": "{}", '"': '"“”«»', "'": "'’`", "=": "=", "<": "<", ">": ">", "&": "&"}.items() for m in ms}
ENDINGS = ("ly", "ed", "ing", "s")

#: One token: a link, an HTML tag's name, a Chinese character, a word, a number, a paragraph break, a mark.
TOKEN = re.compile(r"https?://\S+|www\.\S+|href=\"[^\"]*\"|\[\[|</?[A-Za-z]+|[一-鿿]|[^\W\d_一-鿿]+|\d+|\n\s*\n|[^\w\s]")
_RUN = re.compile(r"[A-Za-z0-9+/=]{60,}")

_NAMES = ["break", "link", "wiki", "tag", "chinese", "chinese_function", "n2", "n4", "number", "other", *dict.fromkeys(MARKS.values()), "word", *ENDINGS, "Capital", "UPPER", "letter", *FUNCTION_WORDS]
CODE = {name: i for i, name in enumerate(_NAMES)}
CLASSES = len(CODE)
_FUNCTION_OF = {}
for _group, _words in FUNCTION_WORDS.items():
    for _word in _words.split():
        _FUNCTION_OF.setdefault(_word, _group)


def _mask(*names: str) -> np.ndarray:
    found = np.zeros(CLASSES, bool)
    found[[CODE[n] for n in names]] = True
    return found


_FUNCTION = _mask(*FUNCTION_WORDS)
_WORDS = _FUNCTION | _mask("word", *ENDINGS, "Capital", "UPPER", "letter")
_HAN = _mask("chinese", "chinese_function")
_STOPS = _mask(".", "!", "?")
_LINKS = _mask("link", "wiki")
_NUMBERS = _mask("n2", "n4", "number")
_CASED = _mask("Capital", "UPPER")

#: Tokens of a block; quantiles of prose blocks that bound the normal range; share of a page that must lie outside it.
BLOCK, LOW, HIGH, MOSTLY = 16, 0.002, 0.985, 0.55
#: Mark of a word that stands on the page before, added to its class; symbols of the bigram models.
AGAIN, SYMBOLS = 128, 2 * CLASSES
_BINS, _BIN = 2500, 0.01
_MOST_CACHED = 1 << 20


def _class_of(token: str) -> int:
    c = token[0]
    if token.startswith(("http://", "https://", "www.", "href=")):
        return CODE["link"]
    if "一" <= c <= "鿿":
        return CODE["chinese_function" if token in CHINESE_FUNCTION else "chinese"]
    if c == "\n":
        return CODE["break"]
    if token == "[[":
        return CODE["wiki"]
    if c == "<" and len(token) > 1:
        return CODE["tag"]
    if c.isdigit():
        return CODE["n2" if len(token) <= 2 else "n4" if len(token) == 4 else "number"]
    if not c.isalpha():
        return CODE[MARKS.get(c, "other")]
    low = token.lower()
    if low in _FUNCTION_OF:
        return CODE[_FUNCTION_OF[low]]
    if len(token) == 1:
        return CODE["letter"]
    if token.isupper():
        return CODE["UPPER"]
    if c.isupper():
        return CODE["Capital"]
    return CODE[next((e for e in ENDINGS if low.endswith(e)), "word")]


class _Codes(dict):
    def __missing__(self, token: str) -> int:
        if len(self) >= _MOST_CACHED:
            self.clear()
        self[token] = code = _class_of(token)
        return code


_CODES = _Codes()


def encode(text: str) -> tuple[np.ndarray, np.ndarray]:
    """The page's classes and whether each token is a word that stood before. Where most words are capitalised, case is taken as style and dropped."""
    tokens = TOKEN.findall(text)
    codes = np.fromiter(map(_CODES.__getitem__, tokens), np.uint8, len(tokens))
    is_word = _WORDS[codes]
    shown = is_word & ~_FUNCTION[codes]
    if shown.any() and (_CASED[codes] & shown).sum() > 0.6 * shown.sum():
        tokens = [t.lower() if w else t for t, w in zip(tokens, is_word)]
        codes = np.fromiter(map(_CODES.__getitem__, tokens), np.uint8, len(tokens))
    counted = np.flatnonzero(is_word | _HAN[codes])
    words = [tokens[i].lower() for i in counted.tolist()]
    first = {w: i for i, w in zip(range(len(words) - 1, -1, -1), reversed(words))}
    again = np.zeros(len(codes), bool)
    again[counted] = True
    again[counted[list(first.values())]] = False
    return codes, again


def reads_as_prose(codes: np.ndarray) -> bool:
    """Whether a page may train the model: sentences, function words, hardly a link. Says nothing about the page's class."""
    words, han, stops = int(_WORDS[codes].sum()), int(_HAN[codes].sum()), int(_STOPS[codes].sum())
    if int(_LINKS[codes].sum()) >= 3:
        return False
    if han > words:
        return stops >= 3 and (codes == CODE["chinese_function"]).sum() > 0.04 * han
    return words > 30 and stops >= max(3, words / 40) and _FUNCTION[codes].sum() >= 0.25 * words


def _chinese(codes: np.ndarray) -> bool:
    return _HAN[codes].sum() > 0.3 * len(codes)


def trigram_codes(codes: np.ndarray) -> np.ndarray:
    x = np.concatenate(([CODE["break"]] * 2, codes)).astype(np.int64)
    return (x[:-2] * CLASSES + x[1:-1]) * CLASSES + x[2:]


def surprisal_table(counts: np.ndarray, weight: float = 5.0) -> np.ndarray:
    """-log2 p of each trigram of classes: each order is smoothed by the next lower one, the lowest evenly."""
    c3 = counts.reshape(CLASSES, CLASSES, CLASSES)
    c2 = c3.sum(axis=0)
    c1 = c2.sum(axis=0)
    p1 = (c1 + 0.5) / (c1.sum() + 0.5 * CLASSES)
    p2 = (c2 + weight * p1) / (c2.sum(axis=1, keepdims=True) + weight)
    p3 = (c3 + weight * p2) / (c3.sum(axis=2, keepdims=True) + weight)
    return -np.log2(p3).astype(np.float32).ravel()


def block_means(codes: np.ndarray, table: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Mean surprisal of each block and the block borders; the last block takes the rest."""
    s = table[trigram_codes(codes)]
    cuts = np.linspace(0, len(s), max(1, len(s) // BLOCK) + 1).astype(int)
    return np.add.reduceat(s, cuts[:-1]) / np.diff(cuts), cuts


def odd_blocks(codes: np.ndarray, table: np.ndarray, normal: tuple[float, float]) -> tuple[float, float, np.ndarray]:
    """(bits, share of tokens in abnormal blocks, which tokens these are) of a non-empty page."""
    means, cuts = block_means(codes, table)
    odd = (means < normal[0]) | (means > normal[1])
    sizes = np.diff(cuts)
    return float((means * sizes).sum() / len(codes)), float((sizes * odd).sum() / len(codes)), np.repeat(odd, sizes)


def reads_as(codes: np.ndarray, again: np.ndarray, odd: np.ndarray, data_share: float) -> int:
    """1 for a candidate that is clearly a list of keywords, links or tags, 2 for one that is clearly code, a log, data or odd prose, 0 for one that
    may train neither model. Says nothing about the page's verdict."""
    x = codes[odd]
    part = np.bincount(x, minlength=CLASSES) / len(x)
    words, han, links = int(_WORDS[x].sum()), int(_HAN[x].sum()), int(_LINKS[x].sum())
    digits, quotes, code, tags = part[_NUMBERS].sum(), part[CODE['"']], part[[CODE["="], CODE["("], CODE["{"]]].sum(), part[CODE["#"]]
    chinese = han > words
    shown = _WORDS[codes] | _HAN[codes]
    distinct = 1 - again.sum() / max(1, shown.sum())
    if chinese:
        function = (x == CODE["chinese_function"]).sum() / han
    else:
        function = max(_FUNCTION[x].sum() / max(1, words), _FUNCTION[codes].sum() / max(1, _WORDS[codes].sum()))
    if links >= 5 and words <= 3 * links:
        return 1
    if data_share < 0.1 and digits < 0.2 and quotes < 0.1 and code < 0.03 and function < (0.01 if chinese else 0.22) and (distinct < 0.5 or tags > 0.25):
        return 1
    data = data_share > 0.4 or digits > 0.3 or code > 0.12 or (quotes > 0.2 and digits > 0.12)
    return 2 if data or distinct > 0.85 or (not chinese and function > 0.3) else 0


def symbols(codes: np.ndarray, again: np.ndarray) -> np.ndarray:
    return codes.astype(np.int64) + CLASSES * again


def bigram_codes(x: np.ndarray) -> np.ndarray:
    return np.concatenate(([CODE["break"]], x[:-1])) * SYMBOLS + x


def bigram_table(counts: np.ndarray, weight: float = 5.0) -> np.ndarray:
    """-log2 p of each bigram of symbols, smoothed by the symbol's own frequency."""
    c2 = counts.reshape(SYMBOLS, SYMBOLS)
    p1 = (c2.sum(axis=0) + 0.5) / (c2.sum() + 0.5 * SYMBOLS)
    return -np.log2((c2 + weight * p1) / (c2.sum(axis=1, keepdims=True) + weight)).astype(np.float32).ravel()


def _taken_apart(packed: bytes) -> tuple[np.ndarray, np.ndarray]:
    both = np.frombuffer(packed, np.uint8)
    return both & (AGAIN - 1), both >= AGAIN


def score_pages(df: DataFrame, key: str, text: str) -> DataFrame:
    """(key, bits, odd_share, spam) of every row: mean surprisal in bits, share of abnormal blocks, verdict.

    Rows with a null key drop out, repeated rows are judged each by itself, other columns are ignored, whatever they are called.
    A null or token-less text gets null ``bits``, ``odd_share`` 0 and is no spam, nor is a text of less than half a block. Texts are read whole. If no page reads as
    prose (such as in an empty table) there is no normal range and nothing is spam; nor is anything if no candidate reads clearly
    as a list. One pass over the texts stages a byte per token; the further ones read those bytes only, the last two those of candidates.
    """
    spark = df.sparkSession
    ship_package(spark)
    key_type = df.schema[key].dataType.simpleString()
    source = df.where(F.col(key).isNotNull()).select(F.col(key).alias("k"), F.col(text).alias("t"))

    def read(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for t in batch["t"]:
                t = t or ""
                codes, again = encode(t)
                out.append(((codes + np.uint8(AGAIN) * again).tobytes(), sum(map(len, _RUN.findall(t))) / max(1, len(t)) if len(t) >= 60 else 0.0, reads_as_prose(codes)))
            yield pd.concat([batch[["k"]].reset_index(drop=True), pd.DataFrame(out, columns=["codes", "data", "prose"])], axis=1)

    pages = stage_table(spread(source).mapInPandas(read, f"k {key_type}, codes binary, data double, prose boolean"), "pages")

    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        three, two = np.zeros(CLASSES**3, np.int64), np.zeros(SYMBOLS**2, np.int64)
        for batch in batches:
            for b in batch["codes"]:
                codes, again = _taken_apart(b)
                np.add.at(three, trigram_codes(codes), 1)
                np.add.at(two, bigram_codes(symbols(codes, again)), 1)
        for order, total in ((3, three), (2, two)):
            at = np.flatnonzero(total)
            yield pd.DataFrame({"order": np.full(len(at), order, np.int32), "at": at.astype(np.int32), "n": total[at]})

    three, prose_pairs = np.zeros(CLASSES**3), np.zeros(SYMBOLS**2)
    counted = pages.where("prose").select("codes").mapInPandas(count, "order int, at int, n bigint").groupBy("order", "at").agg(F.sum("n").alias("n")).toPandas()
    for order, total in ((3, three), (2, prose_pairs)):
        of = counted[counted["order"] == order]
        total[of["at"]] = of["n"]
    table = spark.sparkContext.broadcast(surprisal_table(three))

    def measure(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        seen = np.zeros((2, _BINS), np.int64)
        for batch in batches:
            for b in batch["codes"]:
                codes = _taken_apart(b)[0]
                bins = np.minimum((block_means(codes, table.value)[0] / _BIN).astype(int), _BINS - 1)
                np.add.at(seen[int(_chinese(codes))], bins, 1)
        script, at = np.nonzero(seen)
        yield pd.DataFrame({"script": script.astype(np.int32), "bin": at.astype(np.int32), "n": seen[script, at]})

    histogram = np.zeros((2, _BINS))
    measured = pages.where("prose").select("codes").mapInPandas(measure, "script int, bin int, n bigint").groupBy("script", "bin").agg(F.sum("n").alias("n")).toPandas()
    histogram[measured["script"], measured["bin"]] = measured["n"]
    if not histogram.sum():
        normal = [(-np.inf, np.inf)] * 2
    else:
        histogram = np.where(histogram.sum(axis=1, keepdims=True) > 0, histogram, histogram.sum(axis=0, keepdims=True))
        below = histogram.cumsum(axis=1) / histogram.sum(axis=1, keepdims=True)
        normal = [(float(np.searchsorted(row, LOW)) * _BIN, float(np.searchsorted(row, HIGH) + 1) * _BIN) for row in below]

    def look(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            out = []
            for b, data in zip(batch["codes"], batch["data"]):
                codes, again = _taken_apart(b)
                if not len(codes):
                    out.append((None, 0.0, None, 0))
                    continue
                bits, share, odd = odd_blocks(codes, table.value, normal[int(_chinese(codes))])
                candidate = share >= MOSTLY and 2 * len(codes) >= BLOCK
                out.append((bits, share, (codes + np.uint8(AGAIN) * again)[odd].tobytes() if candidate else None, reads_as(codes, again, odd, data) if candidate else 0))
            yield pd.concat([batch[["k"]].reset_index(drop=True), pd.DataFrame(out, columns=["bits", "odd_share", "odd", "kind"])], axis=1)

    looked = stage_table(pages.select("k", "codes", "data").mapInPandas(look, f"k {key_type}, bits double, odd_share double, odd binary, kind int"), "looked")

    def count_kinds(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        total = np.zeros((3, SYMBOLS**2), np.int64)
        for batch in batches:
            for b, kind in zip(batch["odd"], batch["kind"]):
                np.add.at(total[kind], bigram_codes(symbols(*_taken_apart(b))), 1)
        kind, at = np.nonzero(total)
        yield pd.DataFrame({"kind": kind.astype(np.int32), "at": at.astype(np.int32), "n": total[kind, at]})

    pairs = np.zeros((3, SYMBOLS**2))
    pairs[0] = prose_pairs
    kinds = looked.where("kind > 0").select("odd", "kind").mapInPandas(count_kinds, "kind int, at int, n bigint").groupBy("kind", "at").agg(F.sum("n").alias("n")).toPandas()
    pairs[kinds["kind"], kinds["at"]] = kinds["n"]
    models = spark.sparkContext.broadcast([bigram_table(p) if p.any() else None for p in pairs])

    def judge(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            spam = []
            for b in batch["odd"]:
                means = [None if m is None or b is None else float(m[bigram_codes(symbols(*_taken_apart(b)))].mean()) for m in models.value]
                prose, listed, data = means
                spam.append(listed is not None and all(other is None or listed < other for other in (prose, data)))
            yield batch.drop(columns="odd").assign(spam=spam)

    return looked.select("k", "bits", "odd_share", "odd").mapInPandas(judge, f"k {key_type}, bits double, odd_share double, spam boolean").withColumnRenamed("k", key)
