"""Secrets in texts: fixed patterns, and strings that stay incompressible next to what surrounds them.

A candidate is a long run of key characters soon after a sensitive word. Its novelty
is the number of bytes it adds to the compressed form of the surrounding text, with
zstandard primed by a dictionary of identifiers: names and words found in the
dictionary or nearby add little, random strings nearly their whole entropy.
"""

from __future__ import annotations

import re

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StructType

KINDS = ["assign", "access", "hex", "novel"]

# The patterns of the contract; letters of the keyword in either case, ASCII only.
_ASSIGN = re.compile(
    r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII
)
_ACCESS = re.compile(r"AKIA[A-Z0-9]{16,}")
_HEX = re.compile(r"[0-9a-f]{24,}")
#: Lower-case texts whose absence rules the assignment pattern out.
_ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")

#: Words after which a long string is suspicious; fixed values.
SENSITIVE = ("password", "passwd", "pwd", "passphrase", "secret", "token", "apikey", "api_key", "api-key", "api key",
             "auth", "bearer", "credential", "private", "access_key", "access key", "client_id", "signature", "session")
_SENSITIVE = re.compile("|".join(SENSITIVE), re.IGNORECASE | re.ASCII)
# Letters and digits mixed: words and plain numbers are no secrets, however new.
_CANDIDATE = re.compile(
    r"(?<![A-Za-z0-9+/_=-])(?=[A-Za-z0-9+/_=-]*[0-9])(?=[A-Za-z0-9+/_=-]*[A-Za-z])[A-Za-z0-9+/_=-]{16,}"
)

#: Names that programs and settings are made of; fixed values.
IDENTIFIERS = """
import from return class public static final void function const let var string integer boolean number object array
null true false default config configuration settings options parameter argument value values result response request
header headers content type application json username user_name user_id client_id client_secret access_token
refresh_token id_token session_id api_key apikey secret_key private_key public_key authorization bearer basic password
passwd passphrase credential credentials certificate signature algorithm sha256 hmac base64 encode decode environment
variable export process os.environ getenv database host hostname port localhost connection connection_string url uri
https http www example.com service account role region bucket endpoint production development staging testing
ABCDEFGHIJKLMNOPQRSTUVWXYZ abcdefghijklmnopqrstuvwxyz 0123456789 xxxxxxxxxxxxxxxx 0000000000000000 your_token_here
changeme placeholder example_key insert_your_key_here
"""
#: How far after a sensitive word a candidate may start, and how much text on either side primes the compressor.
REACH = 48
SURROUNDING = 256
#: Compressed bytes per character from which on a candidate is reported.
NOVELTY = 0.6


class Novelty:
    def __init__(self):
        import zstandard

        words = zstandard.ZstdCompressionDict(IDENTIFIERS.encode(), dict_type=zstandard.DICT_TYPE_RAWCONTENT)
        self.compressor = zstandard.ZstdCompressor(level=9, dict_data=words, write_checksum=False, write_content_size=False)

    def bytes_per_character(self, before: str, candidate: str, after: str) -> float:
        context = f"{before} {after} ".encode()
        alone = len(self.compressor.compress(context))
        return (len(self.compressor.compress(context + candidate.encode())) - alone) / len(candidate)


def base_spans(text: str) -> list[tuple[str, int, int]]:
    """(kind, start, end) of the patterns' matches, leftmost and not overlapping within a kind."""
    found = []
    low = text.lower()
    if any(w in low for w in _ASSIGN_WORDS):
        # The value is taken whole before its length is judged: a short one is passed over, not cut.
        found += [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m.group(1)) >= 6]
    if "AKIA" in text:
        found += [("access", *m.span()) for m in _ACCESS.finditer(text)]
    found += [("hex", *m.span()) for m in _HEX.finditer(text)]
    return found


def novel_spans(text: str, base: list[tuple[str, int, int]], novelty: Novelty, least: float) -> list[tuple[str, int, int]]:
    """Candidates after a sensitive word that add at least ``least`` bytes per character, outside ``base``."""
    low = text.lower()
    if not any(w in low for w in SENSITIVE):
        return []
    ends = [m.end() for m in _SENSITIVE.finditer(text)]
    found, k = [], 0
    for m in _CANDIDATE.finditer(text):
        start, end = m.span()
        while k + 1 < len(ends) and ends[k + 1] <= start:
            k += 1
        if not ends or not 0 <= start - ends[k] <= REACH or any(s < end and start < e for _, s, e in base):
            continue
        before, after = text[max(0, start - SURROUNDING):start], text[end:end + SURROUNDING]
        if novelty.bytes_per_character(before, m.group(), after) >= least:
            found.append(("novel", start, end))
    return found


def find(docs: DataFrame, column: str = "text", out: str = "spans", least: float = NOVELTY) -> DataFrame:
    """``docs`` with ``out``: array of (kind, start, end) in code points, end exclusive.

    Ordered by start, then kind as listed in ``KINDS``. Null and empty texts have an
    empty array. A column already named ``out`` is replaced; all rows and other
    columns are kept.
    """
    kept = [c for c in docs.columns if c != out]
    chosen = docs.select(*[F.col(f"`{c}`") for c in kept])
    span = pa.list_(pa.struct([("kind", pa.string()), ("start", pa.int64()), ("end", pa.int64())]))

    def run(batches):
        novelty = Novelty()
        for batch in batches:
            found = []
            for text in batch.column(column):
                text = text.as_py() or ""
                base = base_spans(text)
                spans = sorted(base + novel_spans(text, base, novelty, least), key=lambda s: (s[1], KINDS.index(s[0])))
                found.append([dict(zip(("kind", "start", "end"), s)) for s in spans])
            yield pa.RecordBatch.from_arrays(
                [batch.column(c) for c in kept] + [pa.array(found, span)], names=[*kept, out]
            )

    kind = StructType().add("kind", "string").add("start", "long").add("end", "long")
    return chosen.mapInArrow(run, StructType(list(chosen.schema.fields)).add(out, ArrayType(kind)))


def joined(spans: Column) -> Column:
    """kind:start:end of all spans, comma-joined."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
