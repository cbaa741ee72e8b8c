"""OBJ files in splits."""

import random

from pyspark.sql import functions as F

from fieldspark.sources import geometry


def plain(text):
    v, t = [], []
    for line in text.splitlines():
        w = line.split()
        if w[:1] == ["v"]:
            v.append(tuple(map(float, w[1:4])))
        elif w[:1] == ["f"]:
            c = [int(x.split("/")[0]) for x in w[1:]]
            c = [len(v) + i if i < 0 else i - 1 for i in c]
            t += [(c[0], c[k], c[k + 1]) for k in range(1, len(c) - 1)]
    return [(i, *x) for i, x in enumerate(v)], [(i, *x) for i, x in enumerate(t)]


def test_splits_count_on(spark, tmp_path):
    r, lines = random.Random(3), ["# a mesh", "", "o thing"]
    for i in range(3000):
        lines.append(r.choice(["v {} {} {}", "\tv {}   {} {} 1.0"]).format(*[round(r.uniform(-9, 9), r.randrange(6)) for _ in range(3)]))
        if i > 5 and r.random() < 0.4:
            lines.append("f " + " ".join(r.choice(["{}", "{}/1", "{}//2", "{}/3/4"]).format(r.choice([r.randrange(1, i), -r.randrange(1, 5)])) for _ in range(r.randrange(2, 6))))
    text = "\r\n".join(lines) + "\r\n"
    (tmp_path / "m.obj").write_bytes(text.encode())
    want, old = plain(text), spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("134217728", "3000"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = geometry.read_obj(spark, str(tmp_path / "m.obj"))
            assert [[tuple(x) for x in df.orderBy(df.columns[0]).collect()] for df in got] == list(want)
        assert spark.read.text(str(tmp_path / "m.obj")).select(F.col("_metadata.file_block_start")).distinct().count() > 10
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_awkward_lines(spark, tmp_path):
    (tmp_path / "m.obj").write_text("v 1 x\nf 1 1\nf\nvn 0 0 1\nv 1 2 3\nf 1 2 -1 9\n")
    v, t = geometry.read_obj(spark, str(tmp_path / "m.obj"))
    assert [tuple(r) for r in v.orderBy("vid").collect()] == [(0, 1.0, None, None), (1, 1.0, 2.0, 3.0)]
    assert [tuple(r) for r in t.orderBy("tid").collect()] == [(0, 0, 1, 1), (1, 0, 1, 8)]
    (tmp_path / "none.obj").write_text("")
    assert [df.count() for df in geometry.read_obj(spark, str(tmp_path / "none.obj"))] == [0, 0]
