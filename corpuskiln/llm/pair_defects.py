"""Broken prompt and response pairs: noisy labelling functions per defect, joined by an expectation-maximization label model.

Method. For each defect a handful of labelling functions vote +1 (defect), -1 (not) or 0 (abstains). A two-class label model,
whose prior and vote tables are fitted by expectation-maximization on the counts of vote patterns, turns a pattern into a
posterior. Functions that restate each other within a class share their weight, so one fact does not count twice. A pair keeps
every defect whose posterior exceeds that defect's cutoff; cutoffs are chosen on one half of a small set of labelled pairs that
runs through the same functions and are measured on the other half (``cutoff_report``).

Counts that functions need (in which contexts do sentences end, which words exist, which language do a query's words get
answered in) cover all pairs and are joined, never collected. Only contexts of answers that break off are counted: a Bloom
filter of fixed size keeps most others from being shuffled, and the join drops the rest. The driver holds vote patterns only: at
most 3**functions a defect.
"""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from corpuskiln.llm.bloom import holds, merged_filters
from corpuskiln.llm.shingles import mix, word_ids
from corpuskiln.session import ship_package, spread, stage_table

DEFECTS = {"empty": ["e_none", "e_value", "e_letters"], "truncated": ["t_end", "t_context", "t_word", "t_open", "t_function"], "refusal": ["r_phrase", "r_opening", "r_lexicon", "r_short", "r_rest"], "copy": ["c_words", "c_new", "c_share"], "language": ["l_function", "l_learned", "l_script"]}

# Stand-ins for "no value".
NO_VALUE = set("null none nil n/a na nan tbd tba todo undefined empty blank missing unknown pending leer keine kein vacío vacio ninguno ninguna nada vide aucun aucune rien 无 暂无 空 未知".split()) | {"no answer", "no value", "no data", "no response", "not available", "not applicable", "no text", "no content", "sin respuesta", "sin datos", "keine antwort", "keine angabe", "pas de réponse", "non disponible", "n a"}
# Words that label a question.
QUESTION_LABELS = set("question query q prompt ask asked request user input search pregunta consulta frage anfrage suche requête requete recherche 问题 查询 问".split())
# Frequent function words by language.
FUNCTION_WORDS = {
    "en": "the a an of to in and is that for it as was with be by on at this from or had they which were their there been when who will more no if out so what up about into than them can only other some could then do any our over how why you your does won between after before",
    "es": "el la los las de del en y a un una que se por con para su como no más al lo este esta fue ha hasta le tras quién cuándo qué cómo sus es antes o mientras",
    "de": "der die das den dem des und in im ist ein eine einen einem einer zu mit von sich auf für nicht wird sollte wer was wie nach bei aus an am laut bis vor dieser wurde warum als hat um",
    "pt": "o a os as do da dos das de em no na nos nas e um uma que se por para com não mais foi após até ao quem quando como é até antes o pelo pela apesar",
    "it": "il lo la i gli le di del della dei degli delle a al alla in nel nella e un una che si per con non più fu è dopo fino ha chi quando come sono dal dalla",
    "nl": "de het een en van in is op te dat voor met niet was bij naar om uit aan door tot na over werd heeft wie hoe wat waarom er als",
    "fr": "le la les de du des en et un une à au aux est qui que se pour par avec dans ne pas sur selon jusqu avant a été doit plus ce cette qui pourquoi l d s",
}
_FUNCTION = {lang: set(words.split()) for lang, words in FUNCTION_WORDS.items()}
_SPOKEN = {w: tuple(lang for lang in _FUNCTION if w in _FUNCTION[lang]) for known in _FUNCTION.values() for w in known}
# Words that cannot end a sentence.
NOT_LAST = set("the a an of to in and for with by on at from or but our their its his her which who that than as into between because is are was were be has have el la los las de del en y un una que por con para su al o der die das den dem des und im ein eine einen einem einer zu mit von auf für laut le les du des et une à au aux qui pour par avec dans selon l d".split())
# Ways to decline, by language (matched on lower-case text with straight apostrophes).
# The first way needs a first-person word.
DECLINE_FIRST = re.compile(
    r"\b(i|we)('m| am| are|'re)? (really |very )?(sorry,? (but )?(i |we )?)?(just |simply |regretfully |must |have to |will |would |'?d )*(cannot|can ?not|can't|won't|will not|decline|refuse|(not|n't|un)(?= ?able)|(am |'m |are )?(not able|unable)|rather not|do not|don't|have no|lack)\b[^.!?]{0,40}?\b(help|assist|answer|provide|share|discuss|discussing|comment|write|advise|say|speak|cover|continue|comply|access|ability|respond|talk|give|information|not|offer|fulfil|fulfill|support|browse|generate|engage|do that|do this|comfortable|decline)\b"
)
DECLINE_OTHER = re.compile(
    r"\bdecline to\b|\brather not\b|\bnot able to (comply|help|assist|answer|continue|advise|speak|respond|provide|share|discuss)|\bunable to (comply|help|assist|answer|continue|advise|respond|provide|share|discuss)|\b(can|could) ?not (assist|help) you|don't feel comfortable|against my (guidelines|policy|policies|rules)|as an? (ai|language model|text model|assistant model)\b|only a (text|language) model|consult a qualified professional"
    r"|\b(no|any) way of \w+ing|not possible for me|not be appropriate for me|(been|was|am) (told|asked|instructed) not to|nothing (that )?i (am|'m) (permitted|allowed|able)|\bi\b[^.!?]{0,20}\bpass on\b|(outside|beyond) what i (may|can|am)|no (information|answer|details?) (on|about|regarding|concerning) [^.!?]{1,80} can be (given|provided|shared)|(beyond|outside) (of )?my (scope|abilities|remit|knowledge|expertise)|not (permitted|allowed|in a position) to (say|answer|discuss|help|share|comment|talk)|something (that )?i (would rather|can ?not|can't|must|will|won't|am not)|i (would|'d) (prefer|like) not to"
    r"|no me está permitido|no estoy autorizad|no dispongo de|no sería (apropiado|adecuado)|debo (declinar|rehusar)|no es posible para mí|no quiero (hablar|opinar)|prefiero no|fuera de mi alcance"
    r"|mir (leider )?nicht (möglich|erlaubt|gestattet)|nicht in der lage|kann (ich )?dazu (leider )?nichts|ich (darf|möchte|werde) (dazu|darüber|hierzu|diese frage)?\s?(leider )?(nicht|nichts|keine)|muss ich (leider )?(ablehnen|passen)|ich bedaure"
    r"|pas en mesure|n'ai pas le droit|dois (décliner|refuser|m'abstenir)|ne m'est pas possible|ne (puis|pourrai|saurais) (pas )?(répondre|vous|donner|aider)|je regrette|je (préfère|préférerais) (ne pas|m'abstenir)"
    r"|\bno (puedo|podemos) (ayudar|responder|contestar|proporcionar|dar|hablar|ofrecer|compartir)|no me es posible|lo siento,? pero|prefiero no|como modelo de lenguaje|no tengo acceso|me niego a|no estoy en condiciones"
    r"|\bkann ich (leider )?nicht|ich kann (leider )?(diese |dazu |ihnen |dir |dabei )*(nicht|keine)|möchte ich mich nicht|darf ich (leider )?nicht|tut mir leid|als sprachmodell|habe ich keinen zugriff|ich habe keinen zugriff"
    r"|\bje ne (peux|suis|souhaite|veux) pas|je ne saurais|il m'est impossible|m'est impossible|je suis désolée?,? mais|en tant que modèle|je n'ai pas accès|je préfère ne pas"
    r"|抱歉|对不起|无法(回答|提供|协助|帮助)|不能(回答|提供|协助|帮助)|作为(一个)?(语言模型|人工智能)"
)
# Pieces of text of which every way to decline holds one; a cheap test before the pattern. The pattern's first branch
# has pieces of its own.
FIRST_BRANCH = "cannot|can not|can't|won't|will not|declin|refus|n't able|not able|unable|rather not|do not|don't|have no|lack".split("|")
HINTS = "decline to|rather not|not able to |unable to |not assist you|not help you|don't feel|against my|as an ai|as a ai|model|only a |consult a|way of |not possible|not be app|not to|nothing |pass on|outside|beyond|no informa|no answer|no detail|not permit|not allow|not in a|something |fer not|like not|siento|puedo|podemos|prefiero|niego|debo|posible|quiero|alcance|autoriz|permitido|dispongo|sería|acceso|estoy|nicht|keine|nichts|ablehnen|passen|bedaure|leid|sprachmodell|ésolé|impossible|pas |préf|dois |regrette|saurai|puis |mesure|possible|抱歉|对不起|无法|不能|作为".split("|")
# Words of which every way to decline but the Chinese ones holds one, and words with which OPENING can begin.
HINT_WORDS = set("cannot not t decline declines declined declining refuse refuses refused unable rather no lack able model consult only comfortable against ai way nothing pass outside beyond something prefer like siento puedo podemos prefiero niego debo posible quiero alcance autorizado autorizada permitido dispongo sería acceso estoy nicht keine keinen nichts ablehnen passen bedaure leid sprachmodell désolé désolée impossible pas préfère préférerais dois regrette saurai saurais puis pourrai mesure possible modelo modèle guidelines policy policies rules information answer details detail".split())
OPENING_WORDS = set("hello hi thanks thank unfortunately regrettably apologies please i id sorry not unable that this as lo no como leider dazu das diese als dabei tut es je il désolé en".split())
OPENING = re.compile(r"^\W*((hello|hi|thanks for asking|thank you for asking|unfortunately|regrettably|apologies|please)\W+)?((i'm|i am) (so |very |really )?sorry,? but|sorry,? (but )?(i|we) |i (cannot|can't|won't|must|don't|do not|have no|am (not able|unable|only)|'?d rather|would rather)|not able to|unable to|that is something i|this request|as an? (ai|language|text)|lo siento|no (puedo|me es)|como modelo|leider|dazu|das kann|diese frage|als sprachmodell|dabei|tut mir|es tut mir|je (ne|suis désolé)|il m'est|désolé|en tant que|抱歉|对不起)", re.I)
# Words for the first person, and words of which a refusal in the first person holds three or more.
FIRST_PERSON = set("i me my mi yo mich mir ich je j m moi eu io".split())
REFUSAL_WORDS = re.compile(r"\b(not|no|cannot|can't|won't|nothing|unable|declin\w+|refus\w+|sorry|regret\w*|apolog\w+|unfortunately|permitted|allowed|possible|appropriate|pass|outside|guidelines|polic\w+|rather|told|comfortable|lack|model|appreciate|however|discuss|respond|comment|request|question|lamento|siento|puedo|posible|permitido|responder|pregunta|acceso|disculp\w*|leider|nicht|keine?n?|möglich|frage|darf|beantworten|zugriff|bedaur\w+|désolée?|peux|pas|impossible|permis|répondre|question|accès|regrette|malheureusement)\b|抱歉|无法|不能|不便|回答|问题")
# Polite sentences that may stand beside a refusal.
POLITE = re.compile(r"^\W*(hello|hi|thanks for asking|thank you for asking|let me know|is there anything else|please (try|check|contact|consult)|you may want to|you could|feel free|gracias|puede consultar|hay algo más|danke|gibt es sonst|merci|y a-t-il|vous pouvez|sie können|请)", re.I)

_INVISIBLE = re.compile(r"[\s​-‏⁠﻿­⠀ㅤ]+")
_WORD = re.compile(r"[^\W\d_]+|\d+")
_SENTENCE = re.compile(r"(?<=[.!?。！？])\s+")
# What may follow a sentence's end, what ends a sentence, and what breaks one off.
CLOSERS, TERMINAL, OPEN_END = "'\"”’»)]}*_>」』", ".!?。！？", "…,;:，；：、&+/\\([{-–—"
_BRACKETED = re.compile(r"[.!?。！？]\s*\([^()]*\)$")
_DOTS = re.compile(r"\.\.\.\W*$")
# Unicode ranges of scripts other than Latin; a script counts as a language.
RANGES = {"ja": "\u3040-\u30ff", "zh": "\u4e00-\u9fff", "ko": "\uac00-\ud7af", "cyrillic": "\u0400-\u052f", "arabic": "\u0600-\u06ff", "greek": "\u0370-\u03ff", "hebrew": "\u0590-\u05ff", "devanagari": "\u0900-\u097f", "thai": "\u0e00-\u0e7f"}
SCRIPTS = {name: re.compile(f"[{ranges}]") for name, ranges in RANGES.items()}
_FOREIGN = re.compile(f"[{''.join(RANGES.values())}]")
_HAN = SCRIPTS["zh"]
#: Longest context, in tokens, that is looked up for a sentence end, and how often it must have been seen.
CONTEXT, SEEN = 6, 4
#: Bits of the filter of contexts asked for: a fixed 4 MB, whatever the number of pairs. It saves shuffling, no result depends on it.
ASKED_BITS = 1 << 25
#: Most frequent contexts and words that are joined by broadcast instead of by shuffle: no key left to shuffle holds more than 1 / HOT of the rows.
HOT = 256
#: Votes that need the pair alone, in the order in which ``_votes`` gives them.
ALONE = ["e_none", "e_value", "e_letters", "c_words", "c_new", "c_share", "r_phrase", "r_opening", "r_lexicon", "r_short", "r_rest", "t_end", "t_open", "t_function", "l_function", "l_script"]


_SIGN = {-1: "0", 0: "1", 1: "2"}


def _bare(text: str | None) -> str:
    if not text:
        return ""
    if text.isascii():
        return " ".join(text.split())
    return _INVISIBLE.sub(" ", text if unicodedata.is_normalized("NFC", text) else unicodedata.normalize("NFC", text)).strip()


def _declines(low: str, said: set[str]) -> bool:
    """Whether any way to decline is in the text; the patterns only run where a piece of theirs is there."""
    return ("i" in said or "we" in said) and _holds_one(low, FIRST_BRANCH) and bool(DECLINE_FIRST.search(low)) or _holds_one(low, HINTS) and bool(DECLINE_OTHER.search(low))


def _holds_one(low: str, pieces: list[str]) -> bool:
    for piece in pieces:
        if piece in low:
            return True
    return False


def _no_value(text: str) -> bool:
    core = text.strip(" \"'`.,;:!?()[]{}<>-–—_*#/\\|=~…").lower()
    return core in NO_VALUE or not any(c.isalnum() for c in core)


def language_of(text: str, words: list[str] | None = None) -> tuple[str | None, int]:
    """The language whose function words lead, with the lead; another script's if it has a fifth of the letters (names may be Latin)."""
    words = _WORD.findall(text.lower()) if words is None else words
    if not text.isascii() and _FOREIGN.search(text):
        letters = sum(map(len, words))
        for script, marks in SCRIPTS.items():
            if letters and 5 * len(marks.findall(text)) > letters:
                return script, 9
    votes = dict.fromkeys(_FUNCTION, 0)
    for languages in filter(None, map(_SPOKEN.get, words)):
        for language in languages:
            votes[language] += 1
    best = max(votes, key=votes.__getitem__)
    n = votes.pop(best)
    m = max(votes.values())
    return (best, n - m) if n > m else (None, 0)


# Kinds of characters (in the two low bits: 0 separates, 1 letters, 2 digits, 3 marks) and marks of capitals and sentence ends.
_UPPER, _STOP, _UNSEEN = 4, 8, 255
_KIND, _LOWER = np.full(0x110000, _UNSEEN, np.uint8), np.zeros(0x110000, np.uint32)
# An odd factor, its inverse modulo 2**64, and the hashes of numbers and of capitalised words.
_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_NUMBER, _NAME = np.uint64(0x243F6A8885A308D3), np.uint64(0x13198A2E03707344)
_POWERS: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _kinds(code: np.ndarray) -> np.ndarray:
    """Kind and marks of each code point; those not seen before are looked up one by one."""
    kinds = _KIND[code]
    if (kinds == _UNSEEN).any():
        for c in np.unique(code[kinds == _UNSEEN]).tolist():
            ch = chr(c)
            low = ch.lower()
            _LOWER[c] = ord(low) if len(low) == 1 else c
            kind = 2 if ch.isdecimal() else 1 if ch.isalnum() else 0 if ch.isspace() or ch == "_" else 3
            _KIND[c] = kind + (_UPPER if ch.isalpha() and ch.isupper() else 0) + (_STOP if ch in TERMINAL else 0)
        kinds = _KIND[code]
    return kinds


def token_runs(code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(first, end, kind with marks of the first character) of each token: a run of letters, a run of digits or a mark."""
    kinds = _kinds(code)
    plain = kinds & 3
    begins = np.ones(len(code), bool)
    begins[1:] = (plain[1:] != plain[:-1]) | (plain[1:] == 3)
    first = np.flatnonzero(begins)
    end = np.append(first[1:], len(code))
    token = plain[first] > 0
    return first[token], end[token], kinds[first[token]]


def _run_hashes(code: np.ndarray, first: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hashes of the runs of code points: equal runs have equal hashes, wherever they stand."""
    if len(_POWERS[0]) < len(code):
        for i, factor in enumerate((_BASE, _INVERSE)):
            _POWERS[i] = np.concatenate((np.ones(1, np.uint64), np.cumprod(np.full(2 * len(code), factor, np.uint64))))
    sums = np.zeros(len(code) + 1, np.uint64)
    np.cumsum((code.astype(np.uint64) + np.uint64(1)) * _POWERS[0][:len(code)], out=sums[1:])
    return mix((sums[end] - sums[first]) * _POWERS[1][first] + (end - first).astype(np.uint64))


class Sentences:
    """Tokens of several texts in one line. In contexts they count in lower case, numbers as 0 and capitalised words within a sentence as X."""

    def __init__(self, texts: list[str]):
        code = np.frombuffer("\n".join(texts).encode("utf-32-le", "surrogatepass"), np.uint32)
        first, end, kind = token_runs(code)
        begins = np.cumsum([0, *(len(t) + 1 for t in texts)])[:len(texts)]
        sizes = np.bincount(np.searchsorted(begins, first, side="right") - 1, minlength=len(texts)) if len(first) else np.zeros(len(texts), np.int64)
        self.words = _run_hashes(code, first, end)
        self.ends = np.cumsum(sizes)
        self.position = np.arange(len(first)) - np.repeat(self.ends - sizes, sizes)
        stop = (kind & _STOP) > 0
        starts = self.position == 0
        starts[1:] |= stop[:-1]
        value = np.where((kind & 3) == 2, _NUMBER, _run_hashes(_LOWER[code], first, end))
        self.value = np.where(~starts & ((kind & _UPPER) > 0), _NAME, value)
        self.before_stop = np.append(stop[1:], False)
        self.inner = np.ones(len(first), bool)
        self.inner[self.ends[sizes > 0] - 1] = False

    def contexts(self, at: np.ndarray, kept: np.ndarray | None = None) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(positions, hashes) of the 1, 2, ... CONTEXT tokens that end at each position; with a filter only of those in it.

        A context is only asked for together with its own shorter ends, so what fails the filter needs no longer context.
        """
        sums = np.zeros(len(at), np.uint64)
        for n in range(1, CONTEXT + 1):
            long = self.position[at] >= n - 1
            at, sums = at[long], sums[long]
            sums = sums + mix(self.value[at - n + 1] + np.uint64(n))
            hashes = mix(sums + np.uint64(n))
            if kept is not None:
                found = holds(kept, hashes)
                at, sums, hashes = at[found], sums[found], hashes[found]
            yield at, hashes


@lru_cache(1 << 16)
def _asked(q: str) -> tuple[list[str], set[str], str | None, set[str]]:
    """A query's words, their set, its language and the words that may tell the answer's language; queries come up again and again."""
    raw = _WORD.findall(q)
    qw = [w.lower() for w in raw]
    return qw, set(qw), language_of(q, qw)[0], {w.lower() for w in raw if not w[0].isupper() or w.isupper()} | set(qw[:1])


def _votes(query: str | None, texts: list[str | None] | None, hyde: bool) -> tuple:
    """(votes, other, answer language, query language, query words, text if unsure, its last word): what the pair alone tells."""
    texts = [_bare(t) for t in texts or ()]
    text, q = " ".join(t for t in texts if t), _bare(query)
    low = text.lower()
    aw = _WORD.findall(low)
    qw, known, asked, lower = _asked(q)
    stand_in = not aw or all(map(_no_value, texts))
    letters = 0  # counted as far as any vote asks
    for w in aw:
        letters += len(w) if w.isalpha() else 0
        if letters > 20:
            break
    e = (1 if not aw else -1, 1 if stand_in else -1, 1 if letters < 3 else -1 if letters > 20 else 0)

    rest = aw
    while rest and rest[0] in QUESTION_LABELS and (not qw or rest[0] != qw[0]):
        rest = rest[1:]
    k = len(qw)
    repeats = bool(k and rest and len(rest) % k == 0 and rest[:k] == qw and rest == qw * (len(rest) // k))
    new = len([w for w in rest if w not in known and w not in QUESTION_LABELS])
    share = 1 - new / len(rest) if rest else 0
    copied = bool(qw and not new and len(rest) >= k)
    c = (0, 0, 0) if stand_in else (1 if repeats else -1, 1 if copied else -1, 0 if not qw else 1 if share > 0.95 else -1 if share < 0.7 else 0)

    low = low.replace("’", "'")
    said = set(aw)
    declines, others = False, True
    if (not said.isdisjoint(HINT_WORDS) or not low.isascii() and _HAN.search(low)) and _declines(low, said):
        told = [(s, bool(DECLINE_FIRST.search(s) or DECLINE_OTHER.search(s))) for s in _SENTENCE.split(low) if _WORD.search(s)]
        declines, others = any(d for _, d in told), any(not d and not POLITE.search(s) for s, d in told)
    speaks = not FIRST_PERSON.isdisjoint(said) or "我" in low
    r = (
        1 if declines else -1, 1 if aw and (aw[0] in OPENING_WORDS or _HAN.match(aw[0])) and OPENING.search(text.replace("’", "'")) else 0,
        (1 if len(low) < 260 and len(set(REFUSAL_WORDS.findall(low))) >= 3 else 0) if speaks else -1,
        0 if len(text) < 220 else -1, 0 if not aw else 1 if declines and not others else -1,
    )

    end = text.rstrip(CLOSERS + " ")
    done = (end != "" and end[-1] in TERMINAL or text.endswith(")") and bool(_BRACKETED.search(text))) and not ("..." in text and _DOTS.search(text))
    broken = not stand_in and (text.endswith("...") or text[-1:] in OPEN_END)
    used = hyde and not stand_in and not repeats
    unsure = used and not done and not broken
    other = 0 if used and not done else -1
    final, opened = "", False
    if unsure:
        last = _SENTENCE.split(text)[-1]
        opened = last.count('"') % 2 == 1 and text.count('"') % 2 == 1 or last.count("(") > last.count(")") or last.count("“") > last.count("”") and text.count("“") > text.count("”")
        final = (_WORD.findall(last) or [""])[-1]
    t = (1 if used and broken else other if unsure else -1, 1 if opened else other, 1 if unsure and final.lower() in NOT_LAST else other)

    spoken, lead = language_of(text, aw)
    usable = not stand_in and not copied and letters >= 12
    answer = spoken if usable and lead >= 2 else None
    script, asked_script = (x if x in SCRIPTS else "latin" for x in (spoken, asked))
    lang = (0 if answer is None or asked is None else 1 if asked != spoken else -1, 0 if not usable else 1 if script != asked_script else -1 if script != "latin" else 0)
    return "".join(map(_SIGN.__getitem__, e + c + r + t + lang)), other, answer, asked, lower, text if unsure else None, final


#: Pairs with known defects on which cutoffs are chosen: (query, answer, defects).
LABELLED = [
    ("who won the ice relay in Bergholm", "Bergholm Seals took the relay by two lengths after a slow start, and the crowd stayed to sing.", []),
    ("best trail shoes", "Trainers recommend light shoes with a firm heel, because the sole carries most of the load on steep paths", []),
    ("best trail shoes", "N/A", ["empty"]), ("ice relay results", "   ", ["empty"]), ("ice relay results", "[none]", ["empty"]), ("curling plan", "-- ", ["empty"]), ("curling plan", "(no answer)", ["empty"]), ("curling plan", "{}", ["empty"]),
    ("best trail shoes", "Best trail shoes?", ["copy"]), ("best trail shoes", "Question: best trail shoes", ["copy"]), ("ice relay results", "ice relay results ice relay results", ["copy"]), ("ice relay results", "ICE RELAY RESULTS...", ["copy"]),
    ("ice relay results", "Ice relay results: the first heat went to Bergholm Seals by a narrow margin of three seconds.", []),
    ("best trail shoes", "I'm sorry, but I can't help with that question.", ["refusal"]), ("ice relay results", "As a language model, I do not have access to live results.", ["refusal"]), ("ice relay results", "I must decline to comment on this.", ["refusal"]),
    ("resultados de la regata", "Lo siento, pero no puedo responder a esa pregunta.", ["refusal"]), ("Ergebnisse der Regatta", "Dazu kann ich leider nicht antworten.", ["refusal"]), ("résultats de la régate", "Je suis désolé, mais je ne peux pas répondre.", ["refusal"]),
    ("ice relay results", "The club was sorry to say that it could not provide seats for every guest of the final.", []), ("curling plan", "As a junior coach, I cannot praise the warm-up enough, and the club agrees with the plan.", []),
    ("ice relay results", "The referee stopped the relay because the surface of the", ["truncated"]), ("best trail shoes", "Trainers recommend light shoes with a firm heel,", ["truncated"]), ("curling plan", "A week of curling starts with a long session and...", ["truncated"]), ("curling plan", "The captain said \"we were slower than", ["truncated"]),
    ("curling plan", "A week of curling starts with a long session and ends with a day of rest!", []), ("curling plan", "A week of curling starts with a long session and ends with a day of rest. (2019)", []),
    ("best trail shoes", "Los entrenadores recomiendan zapatos ligeros con el talón firme para las cuestas de la montaña.", ["language"]), ("ice relay results", "裁判在场地干燥之前暂停了比赛，下半场推迟了三分钟。", ["language"]), ("who won the ice relay in Bergholm", "Die Mannschaft aus Bergholm gewann das Rennen mit zwei Längen und die Zuschauer blieben bis zum Ende.", ["language"]),
    ("quién ganó la final de la regata", "Los marineros ganaron la final de la regata con dos botes de ventaja y el público cantó hasta el final.", []), ("wer gewann das Finale der Regatta", "Die Mannschaft aus Bergholm gewann das Rennen mit zwei Längen und die Zuschauer blieben bis zum Ende.", []), ("qui a gagné la finale de la régate", "Les marins ont gagné la finale avec deux bateaux et le public est resté jusqu'à la fin.", []),
    ("who coaches the Bergholm Seals", "Lo siento, pero no puedo responder a esa pregunta sobre la liga.", ["refusal", "language"]), ("what is the plan for the final", "Tut mir leid, ich kann zu der Frage über das Finale nicht antworten.", ["refusal", "language"]),
    ("how do the rules of curling work", "Ein Anfänger sollte zuerst mit der Technik beginnen und danach mit dem", ["truncated", "language"]), ("why was the match on ice moved", "El partido de la final se aplazó por la lluvia y la afición se quedó en el", ["truncated", "language"]),
    ("when does the season of rowing start", "undefined", ["empty"]), ("when does the season of rowing start", "???", ["empty"]), ("wann beginnt die Saison", "keine Angabe", ["empty"]), ("cuándo empieza la temporada", "sin respuesta", ["empty"]),
    ("when does the season of rowing start", "The season opens in May with a regatta on the lake; two clubs from the north", ["truncated"]), ("when does the season of rowing start", "The season opens in May, and tickets (for members only", ["truncated"]), ("how do the rules of curling work", "A stone counts when it lies within the hou", ["truncated"]), ("wann beginnt die Saison", "Die Saison beginnt im Mai mit einer Regatta auf dem", ["truncated"]),
    ("when does the season of rowing start", "The season opens in May with a regatta on the lake", []), ("how do the rules of curling work", "Each team throws eight stones, and the nearest stone to the centre counts one point:\n- a stone in the house\n- no guard in front of it", []),
    ("rules of curling", "Rules of curling", ["copy"]), ("rules of curling", "“rules of curling”", ["copy"]), ("rules of curling", "Query: rules of curling?", ["copy"]), ("qui a gagné la finale", "Question : qui a gagné la finale ?", ["copy"]),
    ("rules of curling", "The rules of curling fill forty pages, and beginners learn the first ten of them.", []), ("rules of curling", "Curling rules: the rules of the club apply on its own ice.", []),
    ("rules of curling", "I would rather not discuss this topic.", ["refusal"]), ("who won the ice relay in Bergholm", "Unfortunately, I am not able to provide results of this race.", ["refusal"]), ("règles du curling", "Je ne peux pas répondre à cette question.", ["refusal"]), ("Regeln im Curling", "Darüber darf ich leider nichts sagen.", ["refusal"]),
    ("rules of curling", "The captain said: \"I cannot explain the defeat, but we will train harder.\" The league has not commented.", []), ("who won the ice relay in Bergholm", "No club was able to answer the pace of Bergholm Seals, who won by two lengths.", []),
    ("when does the season of rowing start", "La saison commence en mai avec une régate sur le lac et les clubs du nord.", ["language"]), ("when does the season of rowing start", "Сезон открывается в мае регатой на озере.", ["language"]), ("cuándo empieza la temporada de remo", "The season opens in May with a regatta on the lake, and the clubs from the north arrive by train.", ["language"]), ("wann beginnt die Saison", "The season opens in May with a regatta on the lake, and the clubs from the north arrive by train.", ["language"]),
    ("when does the season of rowing start", "The Regata del Lago opens the season in May, and the Coupe du Nord closes it in the autumn.", []), ("赛季什么时候开始", "赛季从五月开始，第一场比赛在湖上举行。", []),
    ("how do you say regatta in Spanish", "It is called \"regata de vela\" in Spanish, and commentators shorten the word during broadcasts.", []),
]


def _shares(cast: np.ndarray, weight: np.ndarray, post: np.ndarray) -> np.ndarray:
    """How much each function's vote of one kind counts: 1 for one cast independently of the others within the classes, 1 / n for n always cast together."""
    cov = np.zeros((cast.shape[1],) * 2)
    for p in (post, 1 - post):
        w = weight * p
        off = cast - (w @ cast) / max(w.sum(), 1e-9)
        cov += (off * w[:, None]).T @ off
    size = np.sqrt(np.diag(cov))
    with np.errstate(invalid="ignore", divide="ignore"):
        rho = np.clip(np.nan_to_num(cov / np.outer(size, size)), 0, 1)
    np.fill_diagonal(rho, 1.0)
    return 1 / rho.sum(axis=1)


def fit_label_model(patterns: dict[tuple[int, ...], float], rounds: int = 100) -> dict[tuple[int, ...], float]:
    """Posterior of the defect for each vote pattern: a two-class model fitted by EM on pattern counts.

    It starts from the vote sum; an abstention is no evidence; tables are smoothed, and the defect class is the one that positive
    votes speak for. Once it is fitted, functions that cast the same vote together within the classes share its weight in the
    posterior (``_shares``), so a fact that several functions restate counts once. A defect nobody votes for gets posterior 0.
    """
    if not patterns:
        return {}
    keys = list(patterns)
    votes = np.array(keys) + 1  # 0, 1, 2
    weight = np.array([patterns[k] for k in keys], float)
    sums = votes.sum(axis=1) - votes.shape[1]
    post = 1 / (1 + np.exp(-2.0 * sums))
    if not (votes == 2).any():
        return dict.fromkeys(keys, 0.0)
    share = np.ones((2, votes.shape[1]))
    for turn in range(rounds + 1):
        if turn == rounds:
            share = [_shares((votes == v).astype(float), weight, post) for v in (0, 2)]
        prior = (weight @ post + 1) / (weight.sum() + 20)
        log = np.zeros((2, len(keys)))
        for j in range(votes.shape[1]):
            for c, p in ((1, post), (0, 1 - post)):
                table = np.array([weight[votes[:, j] == v] @ p[votes[:, j] == v] for v in (0, 2)]) + np.array([0.2, 1.0] if c else [1.0, 0.2])
                against, speaks = np.log(table / table.sum())
                log[c] += np.array([share[0][j] * against, 0.0, share[1][j] * speaks])[votes[:, j]]
        odds = np.log(prior) - np.log1p(-prior) + log[1] - log[0]
        post = 1 / (1 + np.exp(-np.clip(odds, -50, 50)))
    return {k: float(p) for k, p in zip(keys, post)}


def best_cutoff(truth: list[bool], posterior: list[float]) -> float:
    """The cutoff with the best F1 on labelled pairs; of equally good ones the middle."""
    scored = []
    for cutoff in np.linspace(0.05, 0.95, 19):
        hit = sum(t and p >= cutoff for t, p in zip(truth, posterior))
        wrong = sum(t != (p >= cutoff) for t, p in zip(truth, posterior))
        scored.append((2 * hit / (2 * hit + wrong) if hit else 0.0, float(cutoff)))
    top = max(s for s, _ in scored)
    good = [c for s, c in scored if s == top]
    return good[len(good) // 2]


def label_pairs(df: DataFrame, key: str, query: str, output: str) -> DataFrame:
    """(key, defect, posterior) of every retained label: a row per defect whose posterior reaches its cutoff.

    The answer is the text of the ``hyde`` line or, without one, all line texts together. Null outputs, queries and texts are
    allowed (a null query is never copied and has no language). Keys may be of any type; rows with a null key drop out, rows with
    one key are labelled each by itself; an empty table gives no rows. Other columns are ignored, whatever they are called.
    """
    return _label(df, key, query, output)[0]


def cutoff_report(df: DataFrame, key: str, query: str, output: str) -> DataFrame:
    """(defect, cutoff, fitted, held_out, precision, recall): a row per defect, measured on the labelled pairs the cutoff was not chosen on."""
    return df.sparkSession.createDataFrame(_label(df, key, query, output)[1], "defect string, cutoff double, fitted int, held_out int, precision double, recall double").coalesce(1)


def _look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        got = [_votes(*x) for x in zip(batch.column("q").to_pylist(), batch.column("texts").to_pylist(), batch.column("hyde").to_pylist())]
        alone, other, answer, asked, query_words, unsure, final = zip(*got) if got else ((),) * 7
        texts = [t for t in unsure if t is not None]
        tokens = Sentences(texts)
        contexts = [[] for _ in texts]
        row_of = np.repeat(np.arange(len(texts)), np.diff(tokens.ends, prepend=0))
        for at, hashes in tokens.contexts(tokens.ends[np.diff(tokens.ends, prepend=0) > 0] - 1):
            for i, h in zip(row_of[at].tolist(), hashes.view(np.int64).tolist()):
                contexts[i].append(h)
        each = iter(contexts)
        asked_words = [None if u is None or not w or _HAN.search(w) else w for u, w in zip(unsure, final)]
        hashed = iter(Sentences([w for w in asked_words if w]).words.view(np.int64).tolist())  # a word is one token
        words = [next(hashed) if w else None for w in asked_words]
        ids = np.array([i for x in query_words for i in word_ids(list(x))], np.uint64).view(np.int64)
        offsets = np.cumsum([0, *map(len, query_words)], dtype=np.int32)
        yield pa.RecordBatch.from_arrays(
            [batch.column("id"), batch.column("k"), batch.column("sample"), pa.array(alone, pa.string()), pa.array(other, pa.int32()), pa.array(answer, pa.string()), pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)),
             pa.array([None if u is None else next(each) for u in unsure], pa.list_(pa.int64())), pa.array(words, pa.int64())],
            ["id", "k", "sample", "alone", "other", "answer", "query_words", "contexts", "final"],
        )


def _count(kept: np.ndarray, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(h, ends, n): how often each context in the filter was seen, with and without a sentence's end after it, and each word in it."""
    for batch in batches:
        queries, parts = batch.column("q").to_pylist(), batch.column("texts").to_pylist()
        texts = [_bare(t) for p in parts for t in p or () if t]
        hashes, ended = [], []
        first = 0
        while first < len(texts):  # as much text at a time as stays in the processor's cache
            last, size = first, 0
            while last < len(texts) and (last == first or size + len(texts[last]) <= 1 << 18):
                size += len(texts[last])
                last += 1
            tokens = Sentences(texts[first:last])
            inner = np.flatnonzero(tokens.inner)
            for at, h in tokens.contexts(inner, kept):
                hashes.append(h)
                ended.append(tokens.before_stop[at])
            words = tokens.words[inner]
            words = words[holds(kept, words)]
            hashes.append(words)
            ended.append(np.zeros(len(words), bool))
            first = last
        asked = Sentences(sorted({q for q in queries if q})).words  # only whether a word is there counts
        asked = asked[holds(kept, asked)]
        seen = np.concatenate([asked, *hashes])
        stops = np.concatenate([np.zeros(len(asked), bool), *ended])
        values, at, n = np.unique(seen, return_inverse=True, return_counts=True)
        yield pa.RecordBatch.from_arrays([pa.array(values.view(np.int64)), pa.array(np.bincount(at, stops, len(values)).astype(np.int64)), pa.array(n.astype(np.int64))], ["h", "ends", "n"])


def _with_hot(many: DataFrame, one: DataFrame, key: str, weight: str) -> DataFrame:
    """Inner join on ``key``; the ``HOT`` keys of ``one`` that weigh most are joined by broadcast, so no task gets all rows of a frequent key."""
    top = [r[0] for r in one.orderBy(F.desc(weight), key).limit(HOT).select(key).collect()]  # at most HOT keys
    if not top:
        return many.join(one, key)
    hot = F.col(key).isin(top)
    return many.where(hot).join(F.broadcast(one.where(hot)), key).unionByName(many.where(~hot).join(one.where(~hot).hint("merge"), key))  # at most HOT rows


def _label(df: DataFrame, key: str, query: str, output: str) -> tuple[DataFrame, list[tuple]]:
    spark = df.sparkSession
    ship_package(spark)
    key_type = df.schema[key].dataType.simpleString()
    line = "array<struct<type:string,text:string>>"
    known = spark.createDataFrame([(i, q, [("hyde", a)]) for i, (q, a, _) in enumerate(LABELLED)], f"sample int, q string, o {line}").withColumn("k", F.lit(None).cast(key_type))
    source = spread(df.select(F.col(key).alias("k"), F.col(query).alias("q"), F.col(output).cast(line).alias("o"), F.lit(None).cast("int").alias("sample")).where("k is not null"))
    hyde = F.filter("o", lambda x: x["type"] == "hyde")
    text_of = lambda lines: F.transform(lines, lambda x: x["text"])
    parts = lambda frame: frame.withColumn("hyde", F.coalesce(F.size(hyde) > 0, F.lit(False))).withColumn("texts", F.when(F.col("hyde"), text_of(hyde)).otherwise(text_of("o")))
    both = parts(source.unionByName(known)).select(F.monotonically_increasing_id().alias("id"), "k", "sample", "q", "texts", "hyde")
    facts = stage_table(both.mapInArrow(_look, f"id bigint, k {key_type}, sample int, alone string, other int, answer string, query_words array<bigint>, contexts array<bigint>, final bigint"), "facts")

    # sentence ends and known words, for the answers that break off
    unsure = facts.where("contexts is not null")
    asked = unsure.select("id", F.posexplode("contexts").alias("n", "h")).unionByName(unsure.where("final is not null").select("id", F.lit(CONTEXT).alias("n"), F.col("final").alias("h")))
    packed = spark.sparkContext.broadcast(merged_filters(asked.select("h"), ASKED_BITS)[0].tobytes())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return _count(np.frombuffer(packed.value, np.uint8), batches)

    counted = parts(source).select("q", "texts").mapInArrow(count, "h bigint, ends bigint, n bigint")
    wanted = asked.groupBy("h").agg(F.count(F.lit(1)).alias("weight"))
    seen = stage_table(counted.groupBy("h").agg(F.sum("ends").alias("ends"), F.sum("n").alias("seen")).join(wanted, "h"), "seen")
    looked = _with_hot(asked, seen, "h", "weight").groupBy("id").agg(
        F.max_by(F.when((F.col("n") < CONTEXT) & (F.col("seen") >= SEEN), F.col("ends") / F.col("seen")), F.when((F.col("n") < CONTEXT) & (F.col("seen") >= SEEN), F.col("n"))).alias("rate"),
        F.coalesce(F.max(F.col("n") == CONTEXT), F.lit(False)).alias("there"))

    # the language a query's words get answered in
    spoken = facts.where("sample is null and answer is not null").select(F.explode("query_words").alias("w"), "answer").groupBy("w", "answer").agg(F.count(F.lit(1)).alias("n"))
    per_word = stage_table(spoken.groupBy("w").agg(F.sum("n").alias("n"), F.max_by("answer", F.struct("n", "answer")).alias("lang"), (F.max("n") / F.sum("n")).alias("purity")).where("n >= 5 and purity >= 0.7"), "words")
    learned = _with_hot(facts.where("answer is not null").select("id", F.explode("query_words").alias("w")), per_word, "w", "n").groupBy("id", "lang").agg(F.sum("purity").alias("p")).groupBy("id").agg(F.max_by("lang", F.struct("p", "lang")).alias("learned"))

    whole = facts.join(looked.hint("merge"), "id", "left").join(learned.hint("merge"), "id", "left")
    other, is_unsure = (F.col("other") + 1).cast("string"), F.col("contexts").isNotNull()
    votes = {v: F.substring("alone", i + 1, 1) for i, v in enumerate(ALONE)} | {
        "t_context": F.when(~is_unsure, other).when(F.col("rate").isNull(), "1").when(F.col("rate") < 0.1, "2").when(F.col("rate") > 0.4, "0").otherwise("1"),
        "t_word": F.when(~is_unsure, other).when(F.col("final").isNotNull() & ~F.coalesce("there", F.lit(False)), "2").otherwise("1"),
        "l_learned": F.when(F.col("answer").isNull() | F.col("learned").isNull(), "1").when(F.col("answer") != F.col("learned"), "2").otherwise("0"),
    }
    whole = stage_table(whole.select("k", "sample", *(F.concat(*(votes[f] for f in fs)).alias(d) for d, fs in DEFECTS.items())), "votes")
    labelled = whole.where("sample is not null").toPandas()  # the few labelled pairs
    each = lambda value: F.explode(F.array(*(F.struct(F.lit(d).alias("defect"), value(d)) for d in DEFECTS))).alias("x")
    patterns = whole.where("sample is null").select(each(lambda d: F.col(d).alias("pattern"))).groupBy("x.defect", "x.pattern").agg(F.count(F.lit(1)).alias("n")).collect()  # at most 3**functions rows a defect
    read = lambda pattern: tuple(int(c) - 1 for c in pattern)
    tables, cutoffs, report = {}, {}, []
    for defect in DEFECTS:
        counts = {read(r["pattern"]): float(r["n"]) for r in patterns if r["defect"] == defect}
        for pattern in labelled[defect]:
            counts.setdefault(read(pattern), 0.5)
        posterior = fit_label_model(counts)
        truth = {s: (defect in LABELLED[s][2], posterior[read(p)]) for s, p in zip(labelled["sample"], labelled[defect])}
        chosen, held = ([truth[s] for s in sorted(truth) if s % 2 == half] for half in (0, 1))
        cutoffs[defect] = best_cutoff([t for t, _ in chosen], [p for _, p in chosen])
        told = [t for t, p in held if p >= cutoffs[defect]]
        report.append((defect, cutoffs[defect], len(chosen), len(held), sum(told) / len(told) if told else None, sum(told) / max(1, sum(t for t, _ in held))))
        tables[defect] = F.create_map(*(F.lit(x) for v, p in posterior.items() for x in ("".join(str(i + 1) for i in v), p)))
    kept = whole.where("sample is null").select(F.col("k").alias(key), each(lambda d: F.when(tables[d][F.col(d)] >= cutoffs[d], tables[d][F.col(d)]).alias("posterior")))
    return kept.select(key, "x.defect", "x.posterior").where("posterior is not null"), report


def main_defect(labels: DataFrame, key: str) -> DataFrame:
    """The likeliest label of each pair; of equal ones the most basic (in the order of ``DEFECTS``)."""
    order = F.array_position(F.array(*(F.lit(d) for d in DEFECTS)), F.col("defect"))
    return labels.groupBy(key).agg(F.max_by("defect", F.struct(F.round("posterior", 3), -order)).alias("defect"))
