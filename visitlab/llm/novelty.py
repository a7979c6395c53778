"""Secrets found by their novelty to a dictionary-primed compressor.

Known formats (:data:`KINDS`) are matched by pattern. Beyond them, every long
token in a sensitive context is a candidate: the compressor is primed with a
dictionary of identifiers (common names of code and those of the corpus),
compresses the code before and after the token, and then the same code with the
token in its place. What the token adds
to the compressed size, per byte of it, is its novelty: names that the
dictionary or the surrounding code hold cost little, a random string about as
much as it is long. Candidates of ``NOVELTY`` bytes a byte or more are reported.

Compression works with the fast strategy, which leaves literals as they are: a
byte that no match covers costs a byte, so sizes do not jump with the statistics
of the surroundings. Every input starts with ``LEAD``, one long match, so that it is
never stored uncompressed.

The corpus's identifiers are the letter runs ``[A-Za-z][a-z]{3,15}`` found in the most
documents, counted over all of them, at most ``IDENTIFIERS``, so the dictionary is
bounded whatever the corpus; the commonest stand last, where matches are nearest.

Defined results: a null or empty text has no spans; every input row gives one
row, repeated rows included; a null doc_id stays null; an empty table gives no
rows. Spans count code points, ends exclusive. Extra columns are ignored by
:func:`secrets` and :func:`spans` and kept by :func:`mask`.
"""

from __future__ import annotations

import hashlib
import re
from collections import defaultdict
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import lean
from .tokens import texts_of

#: Patterns of known formats, in the order of their kinds; the check tells
#: whether a match counts.
KINDS = {
    "assign": (re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A),
               lambda m: len(m[2]) >= 6),
    "access": (re.compile(r"AKIA[A-Z0-9]+"), lambda m: len(m[0]) >= 20),
    "hex": (re.compile(r"[0-9a-f]+"), lambda m: len(m[0]) >= 24),
}
NOVEL = "novel"
#: Names that make a context sensitive, and how many code points before a token count.
SENSITIVE = re.compile(r"passw|passphrase|pwd|secret|token|api.?key|access.?key|private.?key|credential|authorization|bearer|signature|ssh-", re.I | re.A)
REACH = 48
#: What every match of a name above, and of the kinds but hex, holds in lower case.
HINTS = (b"passw", b"passphrase", b"pwd", b"secret", b"token", b"api", b"access", b"private", b"credential", b"authorization", b"bearer",
         b"signature", b"ssh-", b"akia")
HEX = re.compile(rb"[0-9a-f]{24}")
#: A candidate token: at least this many characters of keys and encodings.
LEAST = 12
CANDIDATE = re.compile(r"[A-Za-z0-9+/_=.~-]{%d,}" % LEAST)
#: Code points of text around a candidate that it is compressed with.
AROUND = 256
#: Longer tokens are measured in pieces of this many code points; the most novel counts.
PIECE = 512
#: Bytes added for each byte of a candidate from which it is reported.
NOVELTY = 0.92
#: Identifiers that the corpus gives to the dictionary, and the documents that must hold one.
IDENTIFIERS, TEXTS = 4096, 2
#: Parts in which the commonest are chosen before they meet.
LISTS = 16
#: Identifiers of code, always in the dictionary.
NAMES = ("access account address admin alias api app application argument array async auth authentication authorization base body boolean bucket buffer "
         "build bytes cache call callback certificate char class client cluster code column command commit config configuration connect connection "
         "console const constant content context cookie count create credential data database date debug default define delete deploy dev dict "
         "directory docker docs document domain double email enable encoding endpoint engine enum env environment error event example exception "
         "exec expires export false field file filter final flag float folder format function gateway global group handler hash header host "
         "html http https image import index info init input insert instance integer interface internal item json key label length level library "
         "list local localhost log login long main manager map message method mode model module name namespace network node none null number object "
         "option order org output package page parameter parse password path pattern payload permission platform plugin policy pool port prefix "
         "private process product production profile project property protocol provider proxy public query queue read record reference region "
         "register release remote repository request required reset resource response result return role root route row rule runtime sample schema "
         "scope script search secret select self server service session set setting settings signature size socket source stage staging start "
         "state static status storage string struct style suffix switch system table target task template test text thread time timeout timestamp "
         "title token trace transaction true type unique update upload url user username value variable vector version view void web window worker "
         "workspace write xml yaml your").split()
#: Start of every compressed input.
LEAD = " " * 128
PARAMETERS = zstandard.ZstdCompressionParameters(
    strategy=zstandard.STRATEGY_FAST, target_length=1, min_match=4, window_log=18, hash_log=17, write_content_size=False, write_dict_id=False)


def identifiers(docs: DataFrame, most: int = IDENTIFIERS) -> list[str]:
    """The letter runs found in the most documents, the commonest first."""
    words = F.expr(r"array_distinct(regexp_extract_all(cast(text as string), '[A-Za-z][a-z]{3,15}', 0))")
    counted = docs.select(F.explode(words).alias("word")).groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= TEXTS)
    # the best of each of LISTS parts first: what reaches the driver does not grow with the number of partitions
    part = Window.partitionBy(F.pmod(F.xxhash64("word"), F.lit(LISTS))).orderBy(F.desc("n"), "word")
    best = counted.withColumn("place", F.row_number().over(part)).where(F.col("place") <= most)
    return [r["word"] for r in best.orderBy(F.desc("n"), "word").limit(most).collect()]


class Novelty:
    """Marginal compressed size under a dictionary of identifiers."""

    def __init__(self, words: list[str]):
        raw = " ".join([*reversed(words), *NAMES]).encode()
        shared = zstandard.ZstdCompressionDict(raw, dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        shared.precompute_compress(compression_params=PARAMETERS)
        self.compressor = zstandard.ZstdCompressor(compression_params=PARAMETERS, dict_data=shared)

    def size(self, text: str) -> int:
        return len(self.compressor.compress((LEAD + text).encode("utf-8", "replace")))

    def of(self, before: str, token: str, after: str) -> float:
        """Bytes that the token adds, for each byte of it; of a long token, of
        its most novel piece. Measured with the code before, after and on both
        sides, of which the middle value counts: the encoding of a block's
        matches changes in steps that now and then fall on the token."""
        pieces = [token[k:k + PIECE] for k in range(0, len(token), PIECE)]
        around = [(b, a, self.size(b + a)) for b, a in ((before, ""), ("", after), (before, after))]
        return max(sorted((self.size(b + p + a) - bare) / len(p) for b, a, bare in around)[1] for p in pieces if len(p) >= LEAST)


def base_spans(text: str) -> list[tuple[int, str, int]]:
    """(start, kind, end) of the known formats."""
    return [(m.start(), kind, m.end()) for kind, (pattern, counts) in KINDS.items() for m in pattern.finditer(text) if counts(m)]


def novel_spans(text: str, base: list[tuple[int, str, int]], novelty: Novelty) -> list[tuple[int, str, int]]:
    """(start, kind, end) of incompressible tokens in a sensitive context, apart
    from base spans."""
    hints = [m.end() for m in SENSITIVE.finditer(text)]
    if not hints:
        return []
    taken = sorted((a, b) for a, _, b in base)
    out, k, last = [], 0, 0
    for hint in hints:
        at = max(hint, last)  # tokens that start within reach of the hint, each once
        while m := CANDIDATE.search(text, at, hint + REACH + LEAST):
            a = m.start()
            at = last = b = CANDIDATE.match(text, a).end()
            while k < len(taken) and taken[k][1] <= a:
                k += 1
            if k < len(taken) and taken[k][0] < b:
                continue
            if novelty.of(text[max(0, a - AROUND):a], text[a:b], text[b:b + AROUND]) >= NOVELTY:
                out.append((a, NOVEL, b))
    return out


_ORDER = {kind: i for i, kind in enumerate([*KINDS, NOVEL])}
#: The compressor of this worker, by its dictionary.
_READY: dict[str, Novelty] = {}


def found(data: bytes, words: list[str]) -> list[tuple[int, str, int]]:
    """All spans of a text in UTF-8 by start, then kind as listed."""
    low = data.lower()  # A-Z only, as the patterns have it
    if not any(h in low for h in HINTS) and not HEX.search(data):
        return []
    text = data.decode()
    base = base_spans(text)
    key = hashlib.sha256("\n".join(words).encode()).hexdigest()
    if key not in _READY:
        _READY.clear()
        _READY[key] = Novelty(words)
    return sorted(base + novel_spans(text, base, _READY[key]), key=lambda s: (s[0], _ORDER[s[1]], s[2]))


def _told(spans: list[tuple[int, str, int]]) -> str:
    return ",".join(f"{kind}:{a}:{b}" for a, kind, b in spans)


def secrets(docs: DataFrame, words: list[str] | None = None) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256, spans, n_novel of every
    document."""
    words = identifiers(docs) if words is None else words
    sent = docs.sparkSession.sparkContext.broadcast(words)
    counts = [*KINDS, NOVEL]
    schema = "doc_id long, " + ", ".join(f"n_{k} long" for k in counts) + ", base_sha256 string, spans string"
    names = [f.split()[0] for f in schema.split(", ")]

    @lean()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, digest, told = defaultdict(list), [], []
            for data in texts_of(batch["text"]):
                spans = found(data, sent.value)
                for kind in counts:
                    n[kind].append(sum(1 for s in spans if s[1] == kind))
                digest.append(hashlib.sha256(_told([s for s in spans if s[1] != NOVEL]).encode()).hexdigest())
                told.append(_told(spans))
            columns = [batch["doc_id"], *[pa.array(n[k], pa.int64()) for k in counts], pa.array(digest, pa.string()), pa.array(told, pa.string())]
            yield pa.RecordBatch.from_arrays(columns, names)

    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string")).mapInArrow(run, schema)


def spans(docs: DataFrame, words: list[str] | None = None) -> DataFrame:
    """Every span as a row: doc_id, kind, start, end."""
    each = secrets(docs, words).select("doc_id", F.explode(F.split(F.expr("nullif(spans, '')"), ",")).alias("s"))
    part = F.split("s", ":")
    return each.select("doc_id", part[0].alias("kind"), part[1].cast("long").alias("start"), part[2].cast("long").alias("end"))


def mask(docs: DataFrame, words: list[str] | None = None, put: str = "[SECRET]") -> DataFrame:
    """The documents with every span replaced; overlapping spans become one."""
    words = identifiers(docs) if words is None else words
    sent = docs.sparkSession.sparkContext.broadcast(words)
    at = docs.columns.index("text")

    def masked(text: str | None) -> str | None:
        out, end = [], 0
        for a, _, b in found((text or "").encode(), sent.value):
            if a >= end:
                out += [text[end:a], put]
            end = max(end, b)
        return text if not out else "".join(out) + text[end:]

    @lean()
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            columns = list(batch.columns)
            columns[at] = pa.array([masked(t) for t in batch.column(at).to_pylist()], batch.column(at).type)
            yield pa.RecordBatch.from_arrays(columns, schema=batch.schema)

    return docs.mapInArrow(run, docs.schema)
