import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from oracle import compare

from sonorum.plans import registry

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(registry.queries()))
def test_query_matches_sql(spark, name):
    df = registry.queries()[name](spark, SF)
    sql = registry.oracle_sql().get(name)
    if sql is None:
        assert df.count() > 0
    else:
        compare(df, sql, SF)


def test_entry_and_registry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
    assert set(registry.queries()) <= set(entry.queries())


def test_log_mel_of_silence_and_quiet_ends(spark, tmp_path):
    """The last of the 102 frames that touch a clip is not heard in every clip, and silence in none."""
    found = pq.read_table("/root/testdata/sf0.1/embeddings.parquet", filters=[("vec_id", "in", [0, 399, 1617])])
    silent = pa.table({"vec_id": [5000], "embedding": [[0.0] * 64], "label": [0]}, schema=found.schema)
    quiet_end = pa.table({"vec_id": [5001], "embedding": [[1.0] * 8 + [0.0] * 56], "label": [0]}, schema=found.schema)
    pq.write_table(pa.concat_tables([found, silent, quiet_end]), tmp_path / "embeddings.parquet")
    df = registry.queries()["d4_log_mel"](spark, str(tmp_path))
    assert {r["vec_id"]: r["n_frames"] for r in df.collect()} == {0: 102, 399: 101, 1617: 101, 5000: 0, 5001: 101}
    compare(df, registry.oracle_sql()["d4_log_mel"], str(tmp_path))
