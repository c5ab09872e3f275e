import random

import pytest
from pyspark.sql import functions as F

from ticketloom.operators import images

SCHEMA = "ticket_id string, ord long, pixels array<int>"


def one_by_one(rows, threshold):
    """Brute force: each image against all that were kept before."""
    found, out = {}, {}
    for ticket, k, pixels in sorted(rows, key=lambda r: r[1]):
        if pixels:
            mean = sum(pixels) / len(pixels)
            h = sum(1 << i for i, p in enumerate(pixels) if p >= mean)
            seen = found.setdefault(ticket, [])
            keep = all((h ^ x).bit_count() > threshold for x in seen)
            if keep:
                seen.append(h)
        else:
            keep = True
        out[ticket, k] = keep
    return out


def drifting(rng, n):
    """Grids of which many are near to one another, in chains, and some are equal."""
    pool = [[rng.choice((0, 255)) for _ in range(64)] for _ in range(6)]
    for _ in range(n):
        p = list(rng.choice(pool))
        for i in rng.sample(range(64), rng.randint(0, 5)):
            p[i] = 255 - p[i]
        pool.append(p)
        yield p


@pytest.mark.parametrize("threshold,at_once", [(5, 4096), (5, 3), (5, 0), (0, 5), (20, 8), (12, 0), (62, 0)])
def test_kept_images_are_those_of_brute_force(spark, threshold, at_once):
    rng = random.Random(threshold + at_once)
    rows = [(rng.choice(("hot", "hot", "hot", "b", None)), k, p) for k, p in enumerate(drifting(rng, 300))]
    rows += [("b", 1000, None), (None, 1001, []), ("alone", 1002, None)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = {(r["ticket_id"], r["ord"]): r["kept"] for r in images.near_duplicate_images(df, threshold=threshold, at_once=at_once).collect()}
    assert got == one_by_one(rows, threshold)


def test_two_near_hashes_share_a_mask():
    rng = random.Random(1)
    for threshold in (0, 1, 3, 5, 9, 10, 20, 40, 62, 63):
        masks = images._masks(threshold)
        assert threshold > 5 or all(m.bit_count() >= 20 for m in masks)
        for _ in range(300):
            x = sum(1 << i for i in rng.sample(range(64), threshold))
            assert any(x & m == 0 for m in masks)


def test_no_images(spark):
    none = spark.createDataFrame([], SCHEMA)
    assert images.near_duplicate_images(none).count() == 0 and images.near_duplicate_images(none, "exact").count() == 0


def test_images_from_files(spark, tmp_path):
    ramp = bytes(range(0, 256, 4))
    files = {
        "a.pgm": b"P5 8 8 255\n" + ramp,
        "b.pgm": b"P5\n# note\n16 16\n255\n" + b"".join(bytes(x for p in ramp[8 * (y // 2) : 8 * (y // 2) + 8] for x in (p, p)) for y in range(16)),
        "c.ppm": b"P6 8 8 255\n" + bytes(x for p in ramp for x in (255 - p,) * 3),
        "d.png": b"\x89PNG....",
        "e.pgm": b"P5 800 800 255\n" + ramp,
        "f.pgm": b"P5 # no end",
        "g.pgm": b"P",
    }
    for name, data in files.items():
        (tmp_path / name).write_bytes(data)
    read = spark.read.format("binaryFile").load(str(tmp_path)).select(F.lit("t").alias("ticket_id"), F.row_number().over(images_window()).cast("long").alias("ord"), "content", "length")
    grids = {r["ord"]: r["pixels"] for r in images.luminance_grids(read).collect()}
    assert grids[1] == list(ramp) and len(grids[2]) == 64 and grids[3] == [255 - p for p in ramp]
    assert [grids[k] for k in (4, 5, 6, 7)] == [None] * 4
    got = {r["ord"]: r["kept"] for r in images.near_duplicate_images(read).collect()}
    assert got == {1: True, 2: False, 3: True, 4: True, 5: True, 6: True, 7: True}
    twice = read.unionByName(read.filter("ord < 3").withColumn("ord", F.col("ord") + 10))
    assert {r["ord"] for r in images.near_duplicate_images(twice, "exact").filter("not kept").collect()} == {11, 12}


def images_window():
    from pyspark.sql import Window

    return Window.orderBy(F.col("path"))
