"""Secret scan: keyword prefilter, anchored patterns near hits, checksums.

One Aho-Corasick pass over a text finds the keywords of all kinds. A pattern is
only tried where one of its keywords begins, from left to right and not before
the end of the kind's last match: that gives the pattern's leftmost matches
without overlaps. Tokens that embed a checksum count only if it holds. Hex runs
have no keyword and are looked for by themselves.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from functools import lru_cache

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyframe.llm.shared import arrow_map, documents, text_of

#: The kinds in the order of ties, and the digits of embedded checksums.
KINDS = ("assign", "access", "hex", "github", "npm")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"
WORDS = {
    "assign": ("password", "passwd", "secret", "token", "apikey", "api_key"),
    "access": ("akia",),
    "github": ("ghp_", "gho_", "ghu_", "ghs_", "ghr_"),
    "npm": ("npm_",),
}
PATTERNS = {
    "assign": re.compile(r"""(?i:password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.A),
    "access": re.compile(r"AKIA[A-Z0-9]+"),
    "github": re.compile(r"gh[pousr]_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
    "npm": re.compile(r"npm_[A-Za-z0-9]{36}(?![A-Za-z0-9])"),
}
HEX = re.compile(r"[0-9a-f]{16,}")
_LOWER = {c: c + 32 for c in range(65, 91)}
SCHEMA = "doc_id long, n_assign long, n_access long, n_hex long, base_sha256 string, spans string, n_checked long"


def checksum_holds(token: str) -> bool:
    """Whether the last six characters are the CRC-32, in base 62, of the thirty before them."""
    body, said, n = token[-36:-6], token[-6:], 0
    for c in said:
        n = n * 62 + BASE62.index(c)
    return n == zlib.crc32(body.encode())


#: What a match must be, beyond its pattern, to count.
HOLDS = {
    "assign": lambda m: len(m[1]) >= 12,
    "access": lambda m: len(m[0]) >= 18,
    "github": lambda m: checksum_holds(m[0]),
    "npm": lambda m: checksum_holds(m[0]),
}


@lru_cache(maxsize=1)
def _automaton():
    import ahocorasick

    found = ahocorasick.Automaton()
    for kind, words in WORDS.items():
        for word in words:
            found.add_word(word, (kind, len(word) - 1))
    found.make_automaton()
    return found


def scan(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every secret, in code points, by start and then kind."""
    low = text.lower()
    if len(low) != len(text):  # a letter whose lower case is longer would move what follows
        low = text.translate(_LOWER)
    starts: dict[str, list[int]] = {}
    for end, (kind, back) in _automaton().iter(low):
        starts.setdefault(kind, []).append(end - back)
    found = [(m.start(), m.end(), "hex") for m in HEX.finditer(text)]
    for kind, places in starts.items():
        last = 0
        for at in sorted(places):
            if at >= last and (m := PATTERNS[kind].match(text, at)):
                last = m.end()
                if HOLDS[kind](m):
                    found.append((at, last, kind))
    return sorted(found, key=lambda s: (s[0], KINDS.index(s[2])))


def _scanned(batches):
    import pyarrow as pa

    for batch in batches:
        out = []
        for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
            spans = scan(text)
            said = [(kind, f"{kind}:{a}:{b}") for a, b, kind in spans]
            counts = [sum(k == kind for k, _ in said) for kind in KINDS]
            base = ",".join(s for k, s in said if k in KINDS[:3])
            out.append((doc, *counts[:3], hashlib.sha256(base.encode()).hexdigest(), ",".join(s for _, s in said), sum(counts[3:])))
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.int64()]
        names = [c.split()[0] for c in SCHEMA.split(", ")]
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(list(zip(*out)) or [[]] * 7, kinds)], names=names)


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: counts of each kind, the digest of the base spans and all spans.

    Null texts count as empty and have no spans; an empty list's digest is that of
    the empty string. Rows are scanned one by one: repeated rows give repeated
    results, an empty table an empty one. Other columns are ignored.
    """
    return arrow_map(docs.select(F.col(id_col).cast("long"), text_of(text_col)), _scanned, SCHEMA)


def op3_secrets(spark, sf_dir):
    return scan_secrets(documents(spark, sf_dir))
