"""The registered queries over the driver's smallest tables, against SQL or brute force."""

import base64
import math
import zlib
from pathlib import Path

import duckdb
import numpy as np
import pytest

from tallyframe import llm

from test_fingerprint import brute as fingerprint_brute
from test_near_dedup import brute as near_brute
from test_secrets import brute as secret_brute
from test_token_counts import brute as token_brute

SF = "/root/testdata/sf0.001"
TEXTS = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet' ORDER BY doc_id").fetchall())


def run(spark, name):
    return llm.queries()[name](spark, SF)


@pytest.mark.parametrize("name", list(llm.oracle_sql()))
def test_equals_its_sql(spark, name):
    db = duckdb.connect()
    for table in ("documents", "labels"):
        db.sql(f"CREATE VIEW {table} AS SELECT * FROM '{SF}/{table}.parquet'")
    df = run(spark, name)
    cols = sorted(df.columns)
    plain = lambda v: round(v, 6) if isinstance(v, float) else v
    got = sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=str)
    assert got == sorted((tuple(map(plain, r)) for r in db.sql(f"SELECT {', '.join(cols)} FROM ({llm.oracle_sql()[name]})").fetchall()), key=str)


def test_one_query_for_each_operator():
    assert sorted(int(n[2:].split("_")[0]) for n in llm.queries()) == list(range(1, 11))


def test_op2(spark):
    rows = run(spark, "op2_quality").collect()
    assert {r.doc_id for r in rows} == set(TEXTS) and all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) and r.predicted == int(r.score >= 0.7) for r in rows)
    truth = dict(duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall())
    held = [r.predicted == truth[r.doc_id] for r in rows if r.doc_id in truth and r.held_out]
    assert len(held) > 10 and np.mean(held) > 0.9


def test_op3(spark):
    rows = run(spark, "op3_secrets").collect()
    base = lambda spans: ",".join(s for s in spans.split(",") if s.split(":")[0] in ("assign", "access", "hex"))
    assert {r.doc_id: base(r.spans) for r in rows} == {i: secret_brute(t) for i, t in TEXTS.items()}


def test_op4(spark):
    want = {r[0]: r[1:] for r in fingerprint_brute(list(TEXTS.items()))}
    for r in run(spark, "op4_fingerprints").collect():
        got = (r.n_chars, r.edited_sha256, base64.b64decode(r.fingerprint), base64.b64decode(r.edited_fingerprint), r.near_edited, r.near_next)
        assert got[:4] == want[r.doc_id][:4] and all(math.isclose(a, b) for a, b in zip(got[4:], want[r.doc_id][4:]))


def test_op6(spark):
    assert {r.doc_id: (r.n_shingles, r.component_id) for r in run(spark, "op6_near_dedup").collect()} == near_brute(list(TEXTS.items()))


def test_op7(spark):
    rows, shards, size = run(spark, "op7_sharding").collect(), {}, {}
    for r in rows:
        data = TEXTS[r.doc_id].encode()
        assert (r.size, r.text_crc32, r.law, r.grown_shard) == (len(data) + 1, zlib.crc32(data), "bytes", None)
        shards.setdefault(r.shard, []).append(r.slot)
        size[r.shard] = size.get(r.shard, 0) + r.size
    assert len(rows) == len(TEXTS) and all(sorted(s) == list(range(len(s))) for s in shards.values())
    assert len({(TEXTS[r.doc_id], r.shard) for r in rows}) == len(set(TEXTS.values())) and max(size.values()) < 1.2 * sum(size.values()) / 16


def test_op8(spark):
    P = pytest.importorskip("public_tokenizers")
    from tokenizers import Tokenizer

    t, bins, seen = Tokenizer.from_file(P.path("word_bpe_49k.json")), {}, {}
    ids = {i: t.encode(x, add_special_tokens=False).ids + [0] for i, x in TEXTS.items()}
    for r in run(spark, "op8_packing").collect():
        part = ids[r.doc_id][r.start : r.start + r.length]
        assert r.start == 2048 * r.piece and len(part) == r.length and zlib.crc32(np.array(part, "<u4").tobytes()) == r.ids_crc32
        bins.setdefault(r.sequence_id, []).append((r.offset, r.length))
        seen[r.doc_id] = seen.get(r.doc_id, 0) + r.length
    assert seen == {i: len(x) for i, x in ids.items()}
    for b in bins.values():
        ends = [0, *np.cumsum([n for _, n in sorted(b)]).tolist()]
        assert [o for o, _ in sorted(b)] == ends[:-1] and ends[-1] <= 2048
    assert len(bins) <= 1.02 * sum(seen.values()) / 2048 + 1


def test_op9(spark):
    rows = duckdb.sql(f"SELECT doc_id, source, lang, text FROM '{SF}/documents.parquet'").fetchall()
    ids = lambda where: {i for (i,) in duckdb.sql(f"SELECT doc_id FROM '{SF}/labels.parquet' WHERE {where}").fetchall()}
    low = ids("quality = 0")
    got = {(r.source, r.lang, r.tokenizer): (r.documents, r.tokens) for r in run(spark, "op9_token_counts").collect()}
    assert got == token_brute(rows, ids("toxic = 1"), {i: (t or "").split("\n")[0] for i, _, _, t in rows if i in low})


def test_nothing_else_imports_the_subpackage():
    root = Path(llm.__file__).parents[2]
    for path in (root / "tallyframe").rglob("*.py"):
        if "llm" not in path.relative_to(root / "tallyframe").parts:
            assert "tallyframe.llm" not in path.read_text() and "import llm" not in path.read_text()
