"""Small tables with the cases that every operator must take."""

from pyspark.sql import functions as F

#: Columns whose names the operators also use inside.
CLASHES = ["score", "h", "n", "key", "x", "id", "f", "s", "shard", "slot", "ids", "n_tokens", "label", "node", "band", "value", "payload", "digest", "a.b", "__text", "__0", "__out", "__score"]

WORDS = "the quick brown fox jumps over a lazy dog while seven wise owls watch from tall old trees near quiet rivers under bright summer skies".split()


def sentence(seed: int, n: int) -> str:
    out, state = [], seed * 7919 + 13
    for _ in range(n):
        state = (state * 1103515245 + 12345) % (1 << 31)
        out.append(WORDS[state // 65536 % len(WORDS)] + str(state % 97))
    return " ".join(out)


def edge_texts():
    long = sentence(99, 60_000)
    base = sentence(1, 200).split()
    near = [*base[:100], "changed", *base[101:]]
    return [
        None, "", "   \n\t", "12345 !!!", "a", "é", "Ünïcode ünd ß 漢字 テスト 🎉 ok", "it's we'll  x<|endoftext|>y <|endoftext|>", "two words",
        "one two three four", sentence(1, 200), sentence(1, 200), " ".join(near), sentence(2, 150), sentence(3, 150), long, long + " end", "same", "same", "same",
        "nul\x00byte", "line\nline\nline\n" * 30, "'s 't \n 're",
    ]


def documents(spark, extra=()):
    rows = [(i, t, ["en", "de", None][i % 3], ["a", "b", None][i % 3], len(t or "")) for i, t in enumerate(edge_texts())]
    rows += [(None, sentence(1, 200), "en", "a", 1), (None, None, None, None, None), rows[10], rows[10], *extra]
    df = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string, n_chars long")
    return df.select("*", *(F.lit("clash").alias(c) for c in CLASHES))


def vectors(spark):
    import numpy as np

    r = np.random.default_rng(5)
    m = r.standard_normal((60, 8))
    m[10] = m[0] * 2  # same direction
    m[11] = m[1]
    m[12] = m[1] + 0.01
    m[13] = m[2] + 0.05
    rows = [(i, [float(x) for x in v]) for i, v in enumerate(m)]
    rows += [(100, None), (101, []), (102, [0.0] * 8), (103, [1.0, None] * 4), (104, [float("nan")] + [1.0] * 7), (105, [float("inf")] * 8), (106, [1.0, 2.0, 3.0]), (107, [1.0, 2.0, 3.1])]
    rows += [rows[3], (None, rows[4][1]), (None, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    return df.select("*", *(F.lit("clash").alias(c) for c in CLASHES))


def pages(spark):
    rows = [(i, f"http://example.org/{i}", h) for i, h in enumerate([None, "", "a" * 999, "a" * 999, "b" * 1000, "b" * 1000, "b" * 1000, "\r\n\r\nWARC/1.0 \n" * 200, "é\n" * 900, "x" * 300_000])]
    rows += [(50, "http://x y\nz?q=%20é", "spaces"), (51, None, "no url"), (None, "http://n", "b" * 1000), rows[2], rows[2]]
    df = spark.createDataFrame(rows, "page_id long, url string, html string")
    return df.select("*", *(F.lit("clash").alias(c) for c in CLASHES))
