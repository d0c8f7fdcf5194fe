"""Secret scan: fixed patterns, and values beside credential words that cost too many guesses to be ordinary text."""

from __future__ import annotations

import hashlib
import math
import re
from collections.abc import Iterable, Iterator, Mapping
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from gridlore.llm.common import table, text_of
from gridlore.session import materialize

# The patterns of the base spans, their least lengths and their order.
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.IGNORECASE | re.ASCII)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]{24,}")
LEAST_ASSIGN, LEAST_ACCESS = 6, 20
KINDS = ("assign", "access", "hex", "guess")

#: Words that announce a credential, at the start of a word or of a part of a camelCase name, a scheme word that may follow, and
#: the value up to white space or a quote.
CONTEXT = re.compile(
    r"""(?:(?<![A-Za-z])|(?-i:(?<=[a-z])(?=[A-Z])|(?<=[A-Z])(?=[A-Z][a-z])))"""
    r"""(?:(?:password|passwd|passphrase|passcode|pwd|pass|secret|token|api[_-]?key|access[_-]?key|private[_-]?key"""
    r"""|client[_-]?secret|credential|credentials|(?P<auth>auth|authorization)|bearer)["']?\x20*(?:[:=]|\x20is\x20)\x20*["']?"""
    r"""(?:bearer\x20+|(?(auth)basic\x20+|(?!)))?|bearer\x20+["']?)(?P<value>[^\x20\x09-\x0D"'<>,;]+)""",
    re.IGNORECASE | re.ASCII)
_HINTS = ("pass", "pwd", "secret", "token", "key", "credential", "auth", "bearer")

#: log10 of the guesses from which a value counts as a secret: beyond ten billion.
LEAST_GUESSES = 10.0
#: Longest span other than brute force, repeats and walks.
LONGEST = 24
#: Words of a corpus in its dictionary at most, and the texts that must have a word; one row of copies is no evidence.
DICTIONARY, LEAST_TEXTS = 50_000, 3
#: A credential word with what follows it up to the end of its value, for Java: such values never enter the dictionary.
_VALUE = (r"(?i)(?:pass(?:word|wd|phrase|code)?|pwd|secret|token|key|credentials?|auth(?:orization)?|bearer)[\"']?\x20*(?:[:=]|\x20is\x20|\x20)\x20*[\"']?"
          r"(?:(?:bearer|basic)\x20+)?[^\x20\x09-\x0D\"'<>,;]+")
#: Common words and passwords, the commonest first: a word costs its rank.
WORDS = (
    "password the and you for that this with your have from admin login user test guest root secret token key access private public "
    "default example sample welcome letmein monkey dragon master shadow sunshine princess football baseball superman batman trustno "
    "iloveyou hello love star computer internet server system database service account client email name number value string null none "
    "true false change changeme please here more about home page read open close start stop live local host dev prod stage api app web "
    "site data file code open source my new old one two three four summer winter spring autumn january february march april may june july "
    "august september october november december monday friday sunday orange apple banana cheese coffee pepper ginger cookie flower tiger "
    "killer soccer hockey jordan michael jennifer thomas robert daniel george andrew charlie ashley jessica qwerty abc pass word")
KEYBOARD = ("`1234567890-=", "qwertyuiop[]", "asdfghjkl;'", "zxcvbnm,./")
_DATE = re.compile(r"(?:19|20)\d\d[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:0[1-9]|[12]\d|3[01])|(?:0[1-9]|[12]\d|3[01])[-/.]?(?:0[1-9]|1[0-2])[-/.]?(?:19|20)\d\d"
                   r"|(?:19|20)\d\d")


@lru_cache(maxsize=1)
def _ranks() -> dict[str, float]:
    return {word: math.log10(2 + i) for i, word in reversed(list(enumerate(WORDS.split())))}


@lru_cache(maxsize=1)
def _neighbours() -> frozenset[str]:
    """Pairs of keys side by side or one row apart, and letters and digits in sequence, in both directions."""
    found = set()
    rows = [*KEYBOARD, "abcdefghijklmnopqrstuvwxyz", "0123456789"]
    for row in rows:
        found |= {a + b for a, b in zip(row, row[1:])}
    for upper, lower in zip(KEYBOARD[1:], KEYBOARD[2:]):
        found |= {a + b for a, b in zip(upper, lower)}
    return frozenset(found | {pair[::-1] for pair in found})


def _alphabet(value: str) -> float:
    """log10 of the characters a guesser tries at each place."""
    size = (26 * any("a" <= c <= "z" for c in value) + 26 * any("A" <= c <= "Z" for c in value)
            + 10 * any("0" <= c <= "9" for c in value) + 33 * any(33 <= ord(c) < 127 and not c.isalnum() for c in value)
            + 100 * any(ord(c) >= 127 for c in value))
    return math.log10(max(size, 10))


def corpus_words(docs: DataFrame, limit: int = DICTIONARY, least: int = LEAST_TEXTS) -> dict[str, float]:
    """The commonest words of ``docs`` by the number of distinct texts, and log10 of their ranks; at most ``limit``.

    Whole levels of counts are taken from the top while they fit, so the driver gets ``limit`` words at most, however many tasks counted.
    Words are runs of 3 to ``LONGEST`` letters outside the values beside credential words, so a repeated secret is none.
    """
    prose = F.regexp_replace(text_of(), _VALUE, " ")
    found = F.array_distinct(F.split(F.lower(prose), r"[^\p{L}]+"))
    texts = docs.select(F.xxhash64(text_of()).alias("text_key"), found.alias("words"))
    each = texts.select("text_key", F.explode("words").alias("word")).filter(F.length("word").between(3, LONGEST))
    # the bits of 64 hashed places: so many texts at least, and copies count once
    place = F.expr("shiftleft(1L, cast(pmod(text_key, 64) as int))")
    counted = each.groupBy("word").agg(F.count("*").alias("n"), F.bit_count(F.bit_or(place)).alias("texts"))
    level = F.floor(F.log2("n") * 16).cast("int").alias("level")
    counted = materialize(counted.filter(F.col("texts") >= least).select("word", "n", level), "word-counts")
    # a level is a range of counts of 4 %: fewer than a thousand rows whatever the data
    sizes = sorted(((r["level"], r["count"]) for r in counted.groupBy("level").count().collect()), reverse=True)
    total, lowest = 0, None
    for at, size in sizes:
        total += size
        if total > limit:
            break
        lowest = at
    if lowest is None:
        return {}
    top = counted.filter(F.col("level") >= lowest).select("word", "n").collect()
    return {word: math.log10(2 + i) for i, (word, _) in enumerate(sorted(top, key=lambda r: (-r["n"], r["word"])))}


def _with(known: Mapping[str, float]) -> dict[str, float]:
    """The fixed words and ``known``, each at its smaller cost."""
    return {**known, **{word: min(cost, known.get(word, cost)) for word, cost in _ranks().items()}}


def guess_cost(value: str, ranks: Mapping[str, float] | None = None) -> float:
    """log10 of the guesses for the cheapest way to cut ``value`` into words, dates, repeats, keyboard walks and brute force.

    Costs of spans add; every span beyond the first costs a factor of two. Runs of one character and walks cost their first
    character and length. ``ranks`` has the words' costs, the fixed list's unless given. Time and memory grow with the length
    times ``LONGEST``.
    """
    lower, near, each = value.lower(), _neighbours(), _alphabet(value)
    ranks = _ranks() if ranks is None else ranks
    n = len(value)
    best = [0.0] + [math.inf] * n
    brute = [0.0] + [math.inf] * n  # best that ends in brute force, which goes on at no extra cost
    run = walk = 1
    split = math.log10(2)
    for end in range(1, n + 1):
        brute[end] = min(brute[end - 1] + each if end > 1 else math.inf, best[end - 1] + each + (split if end > 1 else 0.0))
        cost = brute[end]
        if end > 1:
            run = run + 1 if lower[end - 1] == lower[end - 2] else 1
            walk = walk + 1 if lower[end - 2:end] in near else 1
        for length, kind in ((run, 0.5), (walk, 1.0)):
            if length >= 3:
                start = end - length
                cost = min(cost, best[start] + split * (start > 0) + each + math.log10(length) + kind)
        for start in range(max(0, end - LONGEST), end - 2):
            if (before := best[start] + split * (start > 0)) < cost and (rank := ranks.get(lower[start:end])) is not None:
                capitals = value[start:end] != lower[start:end]
                cost = min(cost, before + rank + split * capitals)
        for length in (4, 8, 10):
            start = end - length
            if start >= 0 and value[end - 1].isdigit() and value[start].isdigit() and _DATE.fullmatch(value, start, end):
                cost = min(cost, best[start] + split * (start > 0) + (math.log10(120) if length == 4 else math.log10(120 * 366)))
        best[end] = cost
    return best[n]


def find_spans(text: str, least_guesses: float = LEAST_GUESSES, ranks: Mapping[str, float] | None = None) -> list[tuple[str, int, int]]:
    """``kind, start, end`` in code points, by start, then by the order of ``KINDS``; the end is exclusive."""
    spans: list[tuple[str, int, int]] = []
    lower = text.lower()
    if any(hint in lower for hint in _HINTS):
        spans += [("assign", *m.span()) for m in ASSIGN.finditer(text) if len(m[2]) >= LEAST_ASSIGN]
        spans += [("guess", *m.span("value")) for m in CONTEXT.finditer(text) if guess_cost(m["value"], ranks) >= least_guesses]
    if "AKIA" in text:
        spans += [("access", *m.span()) for m in ACCESS.finditer(text) if m.end() - m.start() >= LEAST_ACCESS]
    spans += [("hex", *m.span()) for m in HEX.finditer(text)]
    return sorted(spans, key=lambda s: (s[1], KINDS.index(s[0]), s[2]))


def listed(spans: Iterable[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)


def scan(docs: DataFrame, least_guesses: float = LEAST_GUESSES) -> DataFrame:
    """``doc_id`` with ``spans``, an array of ``kind, start, end``, one row per row; a null or empty text has none.

    The commonest words of ``docs`` join the fixed ones, so prose beside a credential word costs few guesses.
    """
    shared = docs.sparkSession.sparkContext.broadcast(_with(corpus_words(docs)))

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks = shared.value
        for batch in batches:
            found = [[{"kind": k, "start": s, "end": e} for k, s, e in find_spans(text.as_py() or "", least_guesses, ranks)] for text in batch.column(1)]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(found, kind)], names=["doc_id", "spans"])

    kind = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    name = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(run, f"doc_id {name}, spans array<struct<kind:string,start:long,end:long>>")


def op9_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    def of(*kinds: str):
        return F.filter("spans", lambda s: s["kind"].isin(*kinds))

    def text(spans):
        return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")

    found = scan(table(spark, sf_dir, "documents"))
    return found.select("doc_id", *[F.size(of(kind)).cast("long").alias(f"n_{kind}") for kind in KINDS[:3]],
                        F.sha2(text(of(*KINDS[:3])), 256).alias("base_sha256"), text(F.col("spans")).alias("spans"))
