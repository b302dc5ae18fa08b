import pyarrow as pa
import pyarrow.parquet as pq

from amphora.streaming.action_values import stream_action_values


def _identity(df):
    return df


def test_stream_restart_accumulates(spark, tmp_path):
    src = tmp_path / "in"
    src.mkdir()
    schema = pa.schema([("action_id", pa.int32()), ("reward", pa.float64())])
    pq.write_table(pa.table({"action_id": [0, 0, 1], "reward": [1.0, 3.0, 5.0]}, schema), src / "a.parquet")
    sp_schema = spark.read.parquet(str(src)).schema
    out, ck = str(tmp_path / "out"), str(tmp_path / "ck")
    r1 = {r.action_id: (r.n, r.value) for r in
          stream_action_values(spark, str(src), sp_schema, _identity, out, ck).collect()}
    assert r1 == {0: (2, 2.0), 1: (1, 5.0)}
    pq.write_table(pa.table({"action_id": [1, 2], "reward": [7.0, 1.0]}, schema), src / "b.parquet")
    r2 = {r.action_id: (r.n, r.value) for r in
          stream_action_values(spark, str(src), sp_schema, _identity, out, ck).collect()}
    assert r2 == {0: (2, 2.0), 1: (2, 6.0), 2: (1, 1.0)}
