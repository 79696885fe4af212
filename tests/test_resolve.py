from collections import defaultdict
from decimal import Decimal
from fractions import Fraction

from docfacts.operators import resolve, upsert
from docfacts.schemas import OCCURRENCE, RECORD
from pyspark.sql import functions as F
from pyspark.sql import types as T

RECORDS = T.StructType([T.StructField("report_id", T.StringType()), *RECORD.fields])


def record(report_id, lat, lon, mineral="Gold", depth=100.0, grade=2.0):
    return (report_id, mineral, depth, lat, lon, grade, f"DH-{report_id}")


def test_same_site_merges(spark):
    df = spark.createDataFrame(
        [record("a", -22.5, -68.123), record("b", -22.5, -68.123), record("c", -10.0, -50.0)], RECORDS
    )
    occ = resolve.occurrences(df)
    merged = occ.filter("n_reports = 2").first()
    assert (merged.lat_bucket, merged.lon_bucket) == (-22.5, -68.12)
    ids = resolve.links(df).filter("lat_bucket = -22.5").collect()
    assert sorted(r.report_id for r in ids) == ["a", "b"]
    assert tuple(resolve.stats(occ).first()) == (3, 2)
    assert [r.n_reports for r in resolve.search(occ).collect()] == [2, 1]
    assert resolve.search(occ, "").count() == 2 and resolve.search(occ, "Zinc").count() == 0
    assert resolve.lookup(df, "c").first().lat == -10.0
    assert resolve.lookup(df, "nobody").count() == 0


def test_rounding_is_a_grid(spark):
    df = spark.createDataFrame([record("a", -22.504, -68.0), record("b", -22.506, -68.0)], RECORDS)
    assert resolve.occurrences(df).count() == 2, "a bucket edge splits neighbours"


def test_no_records(spark):
    occ = resolve.occurrences(spark.createDataFrame([], RECORDS))
    assert occ.count() == 0 and tuple(resolve.stats(occ).first()) == (0, 0)


def test_large_sites_keep_every_id(spark):
    """One site holds a third of all records; nothing of it is lost."""
    df = spark.range(3000).selectExpr(
        "concat('r', id) AS report_id", "IF(id % 7 = 0, NULL, 'Gold') AS mineral",
        "CAST(id AS double) AS depth_m",
        "IF(id % 3 = 0, -22.5D, CAST(-20 - (id % 50) / 100 AS double)) AS lat",
        "-68D AS lon", "2D AS grade_g_t", "'DH' AS hole_id",
    )
    whole = defaultdict(list)
    for r in df.collect():
        whole[(r.mineral, round(r.lat, 2), r.lon)].append(r.report_id)
    found = defaultdict(list)
    for r in resolve.links(df).collect():
        found[(r.mineral, r.lat_bucket, r.lon_bucket)].append(r.report_id)
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in whole.items()}
    occ = {(r.mineral, r.lat_bucket, r.lon_bucket): r.n_reports for r in resolve.occurrences(df).collect()}
    assert occ == {k: len(v) for k, v in whole.items()} and max(occ.values()) > 800


def test_region_means_are_unweighted(spark):
    rows = [("Gold", -22.5, -68.1, 9, 10.0, 1.0), ("Gold", -22.4, -68.2, 1, 20.0, 2.005)]
    region = resolve.by_region(spark.createDataFrame(rows, OCCURRENCE)).collect()
    # -22.5 rounds away from zero, so the two sites lie in two cells.
    assert [(r.region_lat, r.n_occurrences, r.n_source_reports) for r in region] == [
        (-23.0, 1, 9), (-22.0, 1, 1),
    ]
    rows = [("Gold", -22.1, -68.1, 9, 10.0, 1.0), ("Gold", -22.2, -68.2, 1, 20.0, 2.0)]
    (one,) = resolve.by_region(spark.createDataFrame(rows, OCCURRENCE)).collect()
    assert (one.avg_depth_m, one.avg_grade_g_t, one.n_source_reports) == (15.0, 1.5, 10)


def test_region_rounding_scales_first(spark):
    rows = [("Gold", -22.1, -68.1, 1, 284.45, 284.405)]
    (one,) = resolve.by_region(spark.createDataFrame(rows, OCCURRENCE)).collect()
    assert (one.avg_depth_m, one.avg_grade_g_t) == (284.5, 284.4)


def test_upsert_keeps_the_last_version(spark):
    schema = "report_id string, v long, x string"
    stored = spark.createDataFrame([("a", 1, "old"), ("b", 1, "keep")], schema)
    new = spark.createDataFrame([("a", 2, "new"), ("c", 1, "add"), ("a", 3, "newest")], schema)
    rows = upsert.upsert(stored, new, "report_id", "v").orderBy("report_id").collect()
    assert [(r.report_id, r.x) for r in rows] == [("a", "newest"), ("b", "keep"), ("c", "add")]


def test_means_do_not_depend_on_order_or_partitions(spark):
    """Depths whose double sums differ by order, and region means that lie on a tie."""
    df = spark.range(20_000).selectExpr(
        "concat('r', id) AS report_id", "IF(id % 3 = 0, 'Gold', 'Zinc') AS mineral",
        "CAST(0.1 * (id % 977) + 0.05 AS double) AS depth_m", "-22 + (id % 41) / 100D AS lat", "-68D AS lon",
        "CAST((id * 7919) % 1000 / 1000 AS double) AS grade_g_t", "'DH' AS hole_id",
    )
    found = set()
    for n, seed in ((1, 1), (7, 2), (211, 3)):
        mixed = df.repartition(n, F.xxhash64("report_id", F.lit(seed))).sortWithinPartitions(F.rand(seed))
        occ = resolve.occurrences(mixed)
        sites = sorted(map(repr, occ.collect()))
        found.add((tuple(sites), tuple(sorted(map(repr, resolve.by_region(occ.repartition(n)).collect())))))
    assert len(found) == 1
    exact = defaultdict(list)
    for r in df.collect():
        exact[(r.mineral, Decimal(str(r.lat)).quantize(Decimal("0.01")))].append(Decimal(repr(r.depth_m)))
    means = defaultdict(list)
    for (mineral, lat), depths in exact.items():
        means[(mineral, round(lat))].append(Fraction(sum(depths)) / len(depths))
    wanted = {k: int(float(sum(v) / len(v)) * 10 + 0.5) / 10 for k, v in means.items()}
    got = {(r.mineral, int(r.region_lat)): r.avg_depth_m for r in resolve.by_region(resolve.occurrences(df)).collect()}
    assert got == wanted


def test_a_tie_rounds_the_same_from_any_side(spark):
    sites = [("Gold", -22.1, -68.1, 1, x, 1.0) for x in (211.3, 211.6, 211.35, 211.55)]
    for turn in range(4):
        df = spark.createDataFrame(sites[turn:] + sites[:turn], OCCURRENCE).repartition(turn + 1)
        assert resolve.by_region(df).first().avg_depth_m == 211.5
    thirds = [("Gold", -22.1, -68.1, 1, x, 1.0) for x in (634 / 3 - 1e-13, 634.35 - 2 * 634 / 3, 634 / 3)]
    assert resolve.by_region(spark.createDataFrame(thirds, OCCURRENCE)).first().avg_depth_m == 211.5


def test_runs_merge_to_the_whole(spark):
    rows = [record(f"r{i}", -22.0 - i % 3, -68.0, depth=0.1 * i, grade=float("nan") if i == 5 else 0.01 * i) for i in range(90)]
    rows += [record("huge", -22.0, -68.0, depth=1e30), ("none", None, None, None, None, None, None)]
    df = resolve.with_site(spark.createDataFrame(rows, RECORDS))
    runs = [resolve.totals(df.filter(F.substring("report_id", -1, 1).isin(*part))) for part in ("024", "13579", "68es")]
    parts = runs[0].unionByName(runs[1]).unionByName(runs[2])
    whole = {repr(r) for r in resolve.occurrences(df.drop("lat_bucket", "lon_bucket")).collect()}
    assert {repr(r) for r in resolve.facts_of(resolve.merged(parts)).collect()} == whole
    assert sum("nan" in r for r in whole) == 1 and any("avg_depth_m=None" in r for r in whole)
