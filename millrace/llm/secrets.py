"""Secret scans: Aho-Corasick keyword prefilter, anchored expressions near hits, checksum validation.

Null and empty texts give no spans. Repeated rows give repeated results. Extra columns are not read.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import read, slices, table, texts

KINDS = ("assign", "access", "hex", "github", "npm")
BASE_KINDS = KINDS[:3]
#: Lower-case keyword -> kinds whose expression may start at it.
KEYWORDS = {
    **dict.fromkeys(("password", "passwd", "secret", "token", "apikey", "api_key"), ("assign",)),
    "akia": ("access",),
    **dict.fromkeys(("ghp_", "gho_", "ghu_", "ghs_", "ghr_"), ("github",)),
    "npm_": ("npm",),
}
ASSIGN = re.compile(rb"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
ACCESS = re.compile(rb"AKIA[A-Z0-9]+")
CHECKED = {"github": re.compile(rb"gh[pousr]_([A-Za-z0-9]{36})(?![A-Za-z0-9])"), "npm": re.compile(rb"npm_([A-Za-z0-9]{36})(?![A-Za-z0-9])")}
HEX = re.compile(rb"[0-9a-f]+")
#: Every byte as "h" (lower-case hexadecimal digit) or "."; a run of 16 is then one keyword.
HEX_CLASS = bytes(104 if chr(b) in "0123456789abcdef" else 46 for b in range(256))
HEX_LEAST, ASSIGN_LEAST, ACCESS_LEAST = 16, 12, 18
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"


def checksum_ok(body: bytes) -> bool:
    """Whether the last 6 of 36 characters are the CRC-32 of the first 30 in base 62, zero-padded: the public format of such tokens."""
    n, out = zlib.crc32(body[:30]), ""
    for _ in range(6):
        n, d = divmod(n, 62)
        out = BASE62[d] + out
    return out.encode() == body[30:]


def automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for w, kinds in KEYWORDS.items():
        a.add_word(w, (len(w), kinds))
    a.make_automaton()
    return a


def scan(data: bytes, auto: ahocorasick.Automaton) -> list[tuple[int, int, int]]:
    """(start, kind's number, end) in bytes, sorted. Per kind leftmost and not overlapping."""
    found: list[tuple[int, int, int]] = []
    hits = sorted({(end + 1 - n, kind) for end, (n, kinds) in auto.iter(data.lower().decode("latin-1")) for kind in kinds})
    free = dict.fromkeys(KINDS, 0)
    for at, kind in hits:
        if at < free[kind]:
            continue
        m = (ASSIGN if kind == "assign" else ACCESS if kind == "access" else CHECKED[kind]).match(data, at)
        if not m:
            continue
        if kind == "assign":
            free[kind], keep = m.end(), m.end(2) - m.start(2) >= ASSIGN_LEAST
        elif kind == "access":
            free[kind], keep = m.end(), m.end() - at >= ACCESS_LEAST
        elif keep := checksum_ok(m[1]):
            free[kind] = m.end()
        if keep:
            found.append((at, KINDS.index(kind), m.end()))
    classes, at = data.translate(HEX_CLASS), 0
    while (at := classes.find(b"h" * HEX_LEAST, at)) >= 0:
        end = HEX.match(data, at).end()
        found.append((at, KINDS.index("hex"), end))
        at = end
    return sorted(found)


def in_points(data: bytes, found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """The same spans in code points."""
    if data.isascii():
        return found
    cuts = sorted({x for s, _, e in found for x in (s, e)})
    points, at, n = {}, 0, 0
    for c in cuts:
        n += len(data[at:c].decode())
        at, points[c] = c, n
    return [(points[s], k, points[e]) for s, k, e in found]


def secret_spans(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", redact: str | None = None) -> DataFrame:
    """doc_id, text with each span replaced by `redact` (null if redact is None), spans array<struct<kind, start, end>> in code points. One row per input row, no shuffle."""
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))
    schema = pa.schema([("doc_id", pa.int64()), ("text", pa.string()), ("spans", span)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        auto = automaton()
        for ids, docs in slices(batches):
            new, out = [], []
            for data in docs:
                found = scan(data, auto)
                out.append([{"kind": KINDS[k], "start": s, "end": e} for s, k, e in in_points(data, found)])
                new.append(redacted(data, found, redact) if redact is not None else None)
            yield table(schema, doc_id=ids, text=new, spans=out)

    return texts(df, id_col, text_col).mapInArrow(run, "doc_id long, text string, spans array<struct<kind:string,start:long,end:long>>")


def redacted(data: bytes, found: list[tuple[int, int, int]], mark: str) -> str:
    out, at = [], 0
    for s, _, e in sorted(found):
        if s >= at:
            out += [data[at:s], mark.encode()]
        at = max(at, e)
    return b"".join([*out, data[at:]]).decode()


def op10_secret_scan(spark, sf_dir) -> DataFrame:
    """Contract query: counts and digests of the spans of every document."""
    spans = F.col("spans")
    line = lambda x: F.concat_ws(":", x["kind"], x["start"].cast("string"), x["end"].cast("string"))
    count = lambda kind: F.size(F.filter(spans, lambda x: x["kind"] == kind)).cast("long")
    base = F.filter(spans, lambda x: x["kind"].isin(*BASE_KINDS))
    return secret_spans(read(spark, sf_dir, "documents")).select(
        "doc_id",
        *(count(k).alias(f"n_{k}") for k in BASE_KINDS),
        F.sha2(F.array_join(F.transform(base, line), ",").cast("binary"), 256).alias("base_sha256"),
        F.array_join(F.transform(spans, line), ",").alias("spans"),
    )
