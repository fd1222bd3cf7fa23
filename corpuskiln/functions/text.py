"""Text functions as Columns: analysis for lexical search, titles, slugs, paths, hashing, redaction."""

from __future__ import annotations

import re

import unicodedata

from pyspark.sql import Column
from pyspark.sql import functions as F

from corpuskiln.functions.keys import trim_blanks


def _plain_letters() -> tuple[str, str]:
    """Accented Latin letters and their base letters, by decomposition."""
    pairs = [(chr(i), unicodedata.normalize("NFD", chr(i))) for i in range(0xE0, 0x250)]
    pairs = [(a, d[0]) for a, d in pairs if len(d) > 1 and d[0].isascii() and d[0].islower() and unicodedata.category(a) == "Ll"]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


ACCENTED, PLAIN = _plain_letters()
CJK = r"([\p{IsHan}\p{IsHiragana}\p{IsKatakana}\p{IsHangul}])"


def fold(c: Column) -> Column:
    """Lower case without diacritics (Latin)."""
    return F.translate(F.lower(c), ACCENTED, PLAIN)


def token_string(c: Column) -> Column:
    """Tokens of a text, each with one blank before and after it (so neighbours are two blanks apart); null is empty.

    Tokens are runs of letters and digits in folded text; each CJK character is a token. In this form ``" t "`` is a whole
    token, ``" t"`` a token prefix and ``" a  b "`` a phrase, and all can be counted by plain string replacement, which
    stays in generated code. ASCII text takes a shorter way to the same result.
    """
    text = F.coalesce(c, F.lit(""))
    spaced = F.regexp_replace(fold(text), CJK, " $1 ")
    plain = F.regexp_replace(F.lower(text), "[^a-z0-9]+", "  ")
    whole = F.when(F.octet_length(text) == F.length(text), plain).otherwise(F.regexp_replace(spaced, r"[^\p{L}\p{N}]+", "  "))
    return F.concat(F.lit(" "), F.trim(whole), F.lit(" "))


def token_total(tokens: Column) -> Column:
    """Number of tokens of a ``token_string``."""
    return F.when(F.trim(tokens) == "", F.lit(0)).otherwise((F.length(tokens) - F.length(F.replace(tokens, F.lit("  "), F.lit("")))) / 2 + 1).cast("bigint")


def occurrences(tokens: Column, needle: str) -> Column:
    """How often ``needle`` occurs in a ``token_string`` without overlap."""
    return ((F.length(tokens) - F.length(F.replace(tokens, F.lit(needle), F.lit("")))) / len(needle)).cast("bigint")


def sanitize_term(c: Column) -> Column:
    """Keep letters, digits, apostrophe and underscore, in lower case."""
    return F.lower(F.regexp_replace(c, r"[^\p{L}\p{N}'_]", ""))


def title_of(body: Column, path: Column) -> Column:
    """Markdown title: the first level-1 or -2 heading (the next level-2 heading where that is just "Notes"); org files by
    ``#+TITLE:`` or the first star heading; otherwise the file name without extension. Never null for a non-null path."""
    stem = F.element_at(F.split(F.regexp_replace(path, r"\.[^.]+$", ""), "/"), -1)
    stem = F.when(stem != "", stem).otherwise(path)
    head = trim_blanks(F.regexp_extract(body, r"(?m)^##?\s+(.+)$", 1))
    second = trim_blanks(F.regexp_extract(body, r"(?m)^##\s+(.+)$", 1))
    md = F.when(head.isin("Notes", "📝 Notes") & (second != ""), second).otherwise(head)
    org = trim_blanks(F.regexp_extract(body, r"(?im)^#\+TITLE:\s*(.+)$", 1))
    star = trim_blanks(F.regexp_extract(body, r"(?m)^\*+\s+(.+)$", 1))
    extension = F.lower(F.regexp_extract(path, r"(\.[^.]*)$", 1))
    found = F.when(extension == ".md", md).when(extension == ".org", F.when(org != "", org).otherwise(star))
    return F.when(F.coalesce(found, F.lit("")) != "", found).otherwise(stem)


def slug_segment(c: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(c, r"[^\p{L}\p{N}$]+", "-"), r"^-+|-+$", "")


def path_slug(c: Column) -> Column:
    """URL-safe path: ``___`` separates folders, other runs become dashes, the extension stays; null where no name is left.

    Symbols (emoji) become their hexadecimal code points, joined by dashes.
    """
    from corpuskiln.functions.udfs import symbols_to_hex

    plain = F.when(c.rlike(r"[\p{So}\p{Sk}]"), symbols_to_hex(c)).otherwise(c)
    parts = F.split(F.replace(plain, F.lit("___"), F.lit("/")), "/", -1)
    folders = F.transform(F.slice(parts, 1, F.size(parts) - 1), slug_segment)
    last = F.element_at(parts, -1)
    extension = F.regexp_extract(last, r"(\.[A-Za-z0-9]+)$", 1)
    name = F.concat(slug_segment(F.left(last, F.length(last) - F.length(extension))), extension)
    whole = F.array_join(F.filter(F.concat(folders, F.array(name)), lambda x: x != ""), "/")
    file = F.element_at(F.filter(F.split(c, "/", -1), lambda x: x != ""), -1)
    return F.when(F.coalesce(trim_blanks(c), F.lit("")).rlike(".") & F.regexp_replace(file, r"\.[^.]+$", "").rlike(r"[\p{L}\p{N}\p{So}\p{Sk}$]") & (whole != ""), whole)


SCHEME = "store://"


def virtual_path(collection: Column, path: Column) -> Column:
    return F.concat(F.lit(SCHEME), collection, F.lit("/"), path)


def virtual_collection(c: Column) -> Column:
    """Collection of a virtual path in any spelling (extra slashes, scheme missing but ``//``); null if it is none."""
    bare = F.regexp_extract(trim_blanks(c), r"^(?:store:)?/{2,}([^/]+)(?:/.*)?$", 1)
    return F.when(bare != "", bare)


def virtual_rest(c: Column) -> Column:
    """Path within the collection of a virtual path; empty for the collection itself, null if it is none."""
    return F.when(virtual_collection(c).isNotNull(), F.regexp_extract(trim_blanks(c), r"^(?:store:)?/{2,}[^/]+/?(.*)$", 1))


def docid(hash_: Column) -> Column:
    """Short id: the first six characters of the content hash."""
    return F.left(hash_, F.lit(6))


def normalized_docid(c: Column) -> Column:
    """A docid as typed (quotes, leading #) reduced to hexadecimal digits in lower case; null if it is none."""
    bare = F.lower(F.regexp_replace(F.regexp_replace(trim_blanks(c), r"^[\"']|[\"']$", ""), "^#", ""))
    return F.when(bare.rlike("^[a-f0-9]{6,}$"), bare)


def is_absolute_path(c: Column) -> Column:
    """Unix, drive-letter (C:\\, C:/) and shell-mounted (/c/) paths."""
    return c.rlike(r"^(/|[A-Za-z]:[\\/]|\\\\)")


def forward_slashes(c: Column) -> Column:
    return F.replace(c, F.lit("\\"), F.lit("/"))


def relative_to(c: Column, prefix: Column) -> Column:
    """Path below ``prefix``; empty if equal, null if elsewhere. A trailing slash of the prefix does not matter."""
    base = F.regexp_replace(forward_slashes(prefix), "/+$", "")
    p = forward_slashes(c)
    return F.when(p == base, F.lit("")).when(F.startswith(p, F.concat(base, F.lit("/"))), F.substr(p, F.length(base) + 2))


def comparable_path(c: Column) -> Column:
    """A path for evaluation: without scheme and collection, lower case, without outer slashes."""
    bare = F.when(F.startswith(c, F.lit(SCHEME)), F.regexp_replace(c, r"^[a-z]+://(?:[^/]*/)?", "")).otherwise(c)
    return F.regexp_replace(F.lower(bare), "^/+|/+$", "")


def paths_match(a: Column, b: Column) -> Column:
    """Whether two paths name one file: equal, or one a suffix of the other."""
    x, y = comparable_path(a), comparable_path(b)
    return (x == y) | F.endswith(x, y) | F.endswith(y, x)


def clean_text(c: Column, fallback: Column, limit: int) -> Column:
    """White space collapsed, cut to ``limit``; the fallback where nothing is left."""
    text = F.trim(F.regexp_replace(F.coalesce(c.cast("string"), fallback), r"\s+", " "))
    return F.left(F.when(text != "", text).otherwise(fallback), F.lit(limit))


def as_rank(c: Column) -> Column:
    """A finite number; null, text and non-finite values are 0."""
    x = c.cast("string").try_cast("double")
    return F.when(x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")), F.lit(0.0)).otherwise(x)


# Words that carry no topic.
TOPIC_STOP_WORDS = "about after also and book books from into that the their this through with".split()
# Words that carry no intent.
INTENT_STOP_WORDS = (
    "am an as at be by do he if in is it me my no of on or so to up us we "
    "all and any are but can did for get has her him his how its let may not our out the too was who why you "
    "also does find from have into more need show some tell that them this want what when will with your "
    "about looking notes search where which"
).split()


def topic_tokens(c: Column) -> Column:
    """Distinct lower-case tokens of four or more characters that begin with a letter, without stop words."""
    found = F.regexp_extract_all(F.lower(F.coalesce(c, F.lit(""))), F.lit(r"([a-z][a-z0-9_-]{3,})"), 1)
    return F.array_except(F.array_distinct(found), F.array(*(F.lit(w) for w in TOPIC_STOP_WORDS)))


def intent_terms(c: Column) -> Column:
    """Terms of an intent: lower case, edge punctuation stripped, longer than one character, no stop words."""
    words = F.transform(F.split(F.lower(F.coalesce(c, F.lit(""))), r"\s+"), lambda t: F.regexp_replace(t, r"^[^\p{L}\p{N}]+|[^\p{L}\p{N}]+$", ""))
    return F.filter(words, lambda t: (F.length(t) > 1) & ~t.isin(INTENT_STOP_WORDS))


def plain_intent_terms(intent: str) -> list[str]:
    """``intent_terms`` of one intent."""
    words = (re.sub(r"^[\W_]+|[\W_]+$", "", t) for t in intent.lower().split())
    return [t for t in words if len(t) > 1 and t not in INTENT_STOP_WORDS]


def json_text(c: Column) -> Column:
    """A JSON string literal of the text."""
    return F.regexp_extract(F.to_json(F.struct(F.coalesce(c, F.lit("")).alias("v"))), r'(?s)^\{"v":(.*)\}$', 1)


def content_hash(body: Column, version: str = "1") -> Column:
    """SHA-256 of the body wrapped in compact JSON with the version of the normalization policy."""
    return F.sha2(F.concat(F.lit('{"content":'), json_text(body), F.lit(f',"normalizationPolicyVersion":"{version}"}}')), 256)


def spaced_json_hash(pairs: list[tuple[str, Column]]) -> Column:
    """SHA-256 of a JSON object with sorted keys and ``", "`` / ``": "`` separators; values are strings."""
    parts = [F.concat(F.lit(f'"{k}": '), json_text(v)) for k, v in sorted(pairs, key=lambda p: p[0])]
    return F.sha2(F.concat(F.lit("{"), F.concat_ws(", ", *parts), F.lit("}")), 256)


def rounded(c: Column, places: int) -> Column:
    """Round halves up on the binary value, as ``floor(x * 10**p + 0.5) / 10**p``."""
    scale = 10**places
    return F.floor(c * scale + 0.5) / scale


# What is replaced before text leaves the engine, in this order.
REDACTIONS = [
    (r"\bBearer\s+[A-Za-z0-9._~+/=-]{8,}", "[redacted-token]"),
    (r"\bsk-[A-Za-z0-9_-]{8,}", "[redacted-key]"),
    (r"(?i)\b(api[_-]?key|secret|password|token)\b\s*[:=]\s*\S+", "$1=[redacted]"),
    (r"https?://[^\s\"']+", "[redacted-url]"),
    (r"(?<![A-Za-z0-9_./-])/(?:Users|home|private|tmp|var)/[^\s\"']+", "[redacted-path]"),
    (r"\b[A-Za-z]:[\\/][^\s\"']+", "[redacted-path]"),
]


def redact(c: Column) -> Column:
    """Secrets, links and local paths replaced."""
    for pattern, put in REDACTIONS:
        c = F.regexp_replace(c, pattern, put)
    return c


# Signs of sensitive text and the reason each stands for, first match wins.
SENSITIVE = [
    ("provider_payload", r"(?i)\bprovider(?:Request|Response)?Payload\b|\bprovider payload\b"),
    ("raw_prompt", r"(?i)\brawPrompt\b|\braw prompt\b"),
    ("raw_completion", r"(?i)\brawCompletion\b|\braw completion\b"),
    ("credential", r"(?i)\b(apiKey|credential|clientSecret|secretKey|secretAccessKey)\b\s*[:=]"),
    ("bearer_token", r"(?i)\bBearer\s+[A-Za-z0-9._~+/=-]{8,}\b"),
    ("api_token", r"(?i)\bsk-[A-Za-z0-9_-]{8,}\b"),
    ("query_log", r"(?i)\bquery\.log\b"),
    ("absolute_path", r"(?i)(^|[^A-Za-z0-9_./-])(?:/(?:Users|home|Volumes|private|tmp|var/folders)/[^\s\"']+|[A-Za-z]:[\\/][^\s\"']+)"),
]


def sensitive_reason(c: Column) -> Column:
    """The first reason why a text is sensitive; null if none."""
    return F.coalesce(*(F.when(c.rlike(pattern), F.lit(reason)) for reason, pattern in SENSITIVE))


# Failure classes, first match wins.
FAILURES = [
    ("rate_limit", r"(?i)\b429\b|rate.?limit|too many requests|quota"),
    ("timeout", r"(?i)timed? ?out|timeout|ETIMEDOUT|deadline"),
    ("network", r"(?i)ECONNRESET|ECONNREFUSED|ENOTFOUND|EPIPE|socket hang up|network|connection (reset|refused|closed)"),
    ("server", r"(?i)\b5\d\d\b|service unavailable|bad gateway|overloaded"),
    ("auth", r"(?i)\b40[13]\b|unauthori[sz]ed|forbidden|invalid api key"),
    ("validation", r"(?i)schema|validation|invalid|missing required"),
]


def failure_class(c: Column) -> Column:
    """The class of a failure message: ``unknown`` if none applies, null for null."""
    return F.when(c.isNotNull(), F.coalesce(*(F.when(c.rlike(p), F.lit(k)) for k, p in FAILURES), F.lit("unknown")))


def is_retryable(kind: Column) -> Column:
    return kind.isin("rate_limit", "timeout", "network", "server")


def staleness_days(now: Column, last: Column) -> Column:
    """Whole days since ``last``."""
    return F.floor((F.unix_timestamp(now) - F.unix_timestamp(last)) / 86400)


def retry_delay_ms(attempt: Column, base: int = 1000, most: int = 60000) -> Column:
    return F.least(F.lit(most), F.lit(base) * F.pow(F.lit(2.0), attempt - 1)).cast("bigint")


def portable_path(c: Column) -> Column:
    """A relative path with forward slashes and without empty and ``.`` parts; null where it is absolute, a URI, home-relative, climbs or is empty."""
    slashed = F.replace(c, F.lit("\\"), F.lit("/"))
    parts = F.filter(F.split(slashed, "/", -1), lambda x: (x != "") & (x != "."))
    bad = (c == "") | F.contains(c, F.lit("\0")) | slashed.rlike(r"^~[^/]*(/|$)") | slashed.startswith("/") | c.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*:")
    return F.when(~bad & (F.size(parts) > 0) & ~F.array_contains(parts, ".."), F.array_join(parts, "/"))


# Pieces of messages that speak of a passing failure of a provider, and patterns of server errors.
TRANSIENT = "concurrency limit|rate limit|temporarily unavailable|stream_read_error|timeout|timed out|service unavailable|gateway timeout|bad gateway|apiconnectionerror|api connection error|connectionerror|connecterror|connecttimeout|readtimeout|clientconnectorerror|serverdisconnectederror|remote protocol error|jina_aiexception|jina ai exception|jina_ai exception|cannot connect to host|network error|fetch failed|ssl|unexpected_eof_while_reading|eof occurred in violation of protocol|connection reset|connection reset by peer|read reset|connection aborted|connection refused|socket hang up|temporary failure in name resolution|getaddrinfo|dns|httpx.|aiohttp.|urllib3.|econnreset|econnrefused|enotfound|etimedout|eai_again|(429)".split("|")
TRANSIENT_PATTERNS = [r"(?i)(?:http|status(?: code)?|error code|code)[^\d]*(5\d\d)", r"(?i)\((5\d\d)\)"]


def is_transient(c: Column) -> Column:
    """Whether a message speaks of a passing failure; null for null."""
    low = F.lower(c)
    found = F.exists(F.array(*(F.lit(t) for t in TRANSIENT)), lambda t: F.contains(low, t))
    for pattern in TRANSIENT_PATTERNS:
        found = found | c.rlike(pattern)
    return F.when(c.isNotNull(), found)


def relative_time(seconds: Column) -> Column:
    """Age in its largest whole unit: ``5s ago``, ``3m ago``, ``2h ago``, ``9d ago``."""
    s = F.floor(seconds)
    unit = lambda size, name: F.concat(F.floor(s / size).cast("string"), F.lit(f"{name} ago"))
    return F.when(s < 60, unit(1, "s")).when(s < 3600, unit(60, "m")).when(s < 86400, unit(3600, "h")).otherwise(unit(86400, "d"))
