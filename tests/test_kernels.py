import numpy as np
from pyspark.sql import functions as F

from tallyframe.kernels import digits, ink


def page():
    return np.full((100, 120), 255, np.uint8)


def test_ink_ignores_frame_lines():
    g = page()
    assert ink.ink_percent(g) == 0.0 and ink.ink_percent(g[:5]) == 0.0 and not ink.has_content(g)
    g[:, 60] = 0
    g[50, :] = 0
    assert ink.ink_percent(g) == 0.0
    g[40:60, 40:60] = 0
    assert 2 < ink.ink_percent(g) < 6 and ink.has_content(g)


def test_lines_blocks_and_borders():
    g = page()
    for y in (10, 11, 60):
        g[y, 5:115] = 0
    assert ink.horizontal_lines(g, gap=5) == [10, 60]
    g = page()
    g[0, :] = 0
    assert ink.border_residue(g) == 1
    g = page()
    g[20:80, 10:30] = 0
    g[45:50, 60:100] = 0
    found = ink.blocks(g)
    assert [(b["x0"], b["x1"], round(b["alto"], 2)) for b in found] == [(10, 29, 0.6), (60, 99, 0.05)]
    assert [d.shape[1] for d in ink.digit_boxes(g, 2)] == [20, 40] and len(ink.digit_boxes(g, 3)) == 3
    assert ink.vote_crop(0, 10, 1000, 30) == (720, 10, 255, 30) or ink.vote_crop(0, 10, 1000, 30)[2] in (254, 255)


def test_columns(spark):
    from tallyframe.functions.checks import block_type

    g = page()
    g[45:50, 60:100] = 0
    df = spark.createDataFrame([(bytearray(g.tobytes()), 100), (None, None)], "pixels binary, h int")
    rows = df.select(ink.ink_column("pixels", "h").alias("tinta"), ink.blocks_column("pixels", "h").alias("b")).collect()
    assert rows[0].tinta > 1 and rows[1].tinta is None
    kinds = df.where("h = 100").select(F.explode(ink.blocks_column("pixels", "h")).alias("b")).select(block_type(F.col("b.ancho"), F.col("b.alto"), F.col("b.relleno")))
    assert [r[0] for r in kinds.collect()] == ["guion"]


def test_digit_models_vote(spark):
    rng = np.random.default_rng(2)
    rows = [(int(k % 3), k // 4, [float(v) for v in rng.normal(size=4) + 6 * np.eye(4)[k % 3]]) for k in range(120)]
    df = spark.createDataFrame(rows, "y int, grupo int, x array<double>")
    got = digits.vote(df, digits.train(df, members=2)).collect()
    assert np.mean([r.digito == r.y for r in got]) > 0.95 and all(0 < r.confianza <= 1 for r in got)
