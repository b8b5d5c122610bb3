import re

from pyspark.sql import functions as F

from partwright.functions.keys import escape_value, extract_keys, layout_pattern, partition_subpath, unescape


def test_escape_rules():
    assert escape_value("a/b") == "a%2Fb"
    assert escape_value("c=d e") == "c%3Dd e"
    assert escape_value("a+b") == "a+b"
    assert escape_value("g%h") == "g%25h"
    assert escape_value("") == "__HIVE_DEFAULT_PARTITION__"
    assert partition_subpath(["k", "d"], ["x:y", "2026-03-01"]) == "k=x%3Ay/d=2026-03-01"


def test_pattern_and_decode(spark):
    pat = layout_pattern(["terr_cd", "store_id", "extract_date"])
    assert re.search(pat, "gs://b/p/terr_cd=T/store_id=S/extract_date=2026-03-01/part-0.parquet")
    assert not re.search(pat, "gs://b/p/terr_cd=T/part-0.parquet")
    df = spark.createDataFrame(
        [("file:/x/terr_cd=a%2Fb/store_id=c+d e/extract_date=2026-03-01/part-0.snappy.parquet",)], "path string"
    )
    raw = extract_keys(F.col("path"), ["terr_cd", "store_id", "extract_date"])
    row = df.select(*[unescape(r).alias(str(i)) for i, r in enumerate(raw)]).first()
    assert tuple(row) == ("a/b", "c+d e", "2026-03-01")


def test_escape_unescape_roundtrip_property(spark):
    """Arbitrary key text survives escape (as Spark writes dirs) and decode."""
    from hypothesis import given, settings
    from hypothesis import strategies as st

    samples = []

    @settings(max_examples=300, deadline=None, database=None)
    @given(st.text(alphabet=st.characters(min_codepoint=1, max_codepoint=0x2FF), min_size=1, max_size=12))
    def collect(v):
        samples.append(v)

    collect()
    rows = [(v, "file:/x/k=" + escape_value(v) + "/part-0.parquet") for v in samples]
    df = spark.createDataFrame(rows, "v string, path string")
    raw = extract_keys(F.col("path"), ["k"])[0]
    bad = df.filter(unescape(raw) != F.col("v")).collect()
    assert bad == []
