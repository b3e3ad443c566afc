import json

from frames import rows

from ledgerlake.sources import evolving
from ledgerlake.streaming import trades as st


def test_nothing_is_lost_across_a_restart(spark, tmp_path):
    land, out, ckpt, schemas = (str(tmp_path / n) for n in ("land", "out", "ckpt", "schemas"))
    evolving.store_schema(spark, schemas, "id bigint, x double")

    def run(lines):
        spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1).write.mode("append").text(land)
        st.drain(evolving.rescuing_stream(spark, land, out, ckpt, schemas))

    run(['{"id": 1, "x": 1.5}', '{"id": "no", "x": 2}', "no json", "", '{"id": 2, "n": 5, "t": "a", "deep": {"k": [1]}}'])
    first = {r["id"]: r for r in spark.read.parquet(out).collect() if r["id"]}
    assert first[1]["_resgatado"] is None
    assert json.loads(first[2]["_resgatado"]) == {"n": "5", "t": "a", "deep": '{"k":[1]}'}
    assert evolving.evolve(spark, out, schemas) == ["deep", "n", "t"]
    assert evolving.stored_schema(spark, schemas).simpleString() == "struct<id:bigint,x:double,deep:string,n:bigint,t:string>"
    run(['{"id": 3, "x": null, "n": 7, "t": "b"}', '{"id": 4, "n": "seven"}'])
    assert evolving.evolve(spark, out, schemas) == []
    got = evolving.read_rescued(spark, out, schemas)
    assert rows(got.where("id is not null")) == sorted([
        (1, 1.5, None, None, None, None), (2, None, '{"k":[1]}', 5, "a", None), (3, None, None, 7, "b", None),
        (4, None, None, None, None, '{"n":"seven"}'),
    ], key=repr)
    # the ill-typed id and the line that is no JSON are still there
    left = [json.loads(r["_resgatado"]) for r in got.where("id is null and _resgatado is not null").collect()]
    assert sorted(left, key=str) == [{"_linha": "no json"}, {"id": "no"}]


def test_a_schema_is_kept_in_versions(spark, tmp_path):
    path = str(tmp_path / "s")
    assert [evolving.store_schema(spark, path, s) for s in ("a int", "a int, b string")] == [1, 2]
    assert evolving.stored_schema(spark, path).names == ["a", "b"]
