import datetime as dt

import pyarrow.parquet as pq
import pytest
from frames import rows
from pyspark.sql import functions as F

from ledgerlake import presets
from ledgerlake.functions import mask_cpf, mask_email, mask_name, pseudonymize, salted_sha256
from ledgerlake.operators.joins import plan_text
from ledgerlake.operators.quality import split_quarantine
from ledgerlake.operators.sets import _replicate, reconcile
from ledgerlake.queries.streams import land
from ledgerlake.sources import readers, scratch, snapshots, tables


def test_payload_reasons(spark):
    ok = '{"timestamp":"t","ticker":"A","preco":1,"quantidade":2,"tipo":"venda","corretora":"c","id_transacao":"1"}'
    cases = {
        ok: presets.REASON_OK,
        ok.replace('"preco":1,', ""): presets.REASON_MISSING + "preco",
        ok.replace('"preco":1', '"preco":"1"'): presets.REASON_PRICE,
        ok.replace('"preco":1', '"preco":null'): presets.REASON_PRICE,
        ok.replace('"preco":1', '"preco":1.25'): presets.REASON_OK,
        ok.replace('"quantidade":2', '"quantidade":2.5'): presets.REASON_QUANTITY,
        ok.replace("venda", "troca"): presets.REASON_SIDE + "troca",
        "{broken": presets.REASON_JSON,
        ok.replace('"timestamp":"t","ticker":"A",', ""): presets.REASON_MISSING + "timestamp",
    }
    df = spark.createDataFrame([(t,) for t in cases], "corpo string")
    got = {r["corpo"]: (r["motivo"], r["valido"]) for r in readers.validate_payload(df, "corpo").collect()}
    assert got == {t: (m, m == presets.REASON_OK) for t, m in cases.items()}
    good, bad = split_quarantine(df, "corpo")
    assert (good.count(), bad.count(), "motivo" in bad.columns) == (2, len(cases) - 2, True)


def test_payloads_are_parsed_once(spark):
    df = spark.createDataFrame([('{"preco": 1}',), (None,), ("x",)], "corpo string")
    good, bad = split_quarantine(df, "corpo")
    for side in (good, bad):
        assert plan_text(side, "simple").count("parseJson") == 1
    assert good.columns == ["corpo"] and bad.columns == ["corpo", "motivo"] and bad.count() == 3


def test_landed_files_have_small_row_groups(spark, tmp_path):
    body = spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 512).cast("binary").alias("Body"))
    land(body, str(tmp_path / "landed"), 2)
    files = list((tmp_path / "landed").glob("*.parquet"))
    assert len(files) == 2 and all(pq.ParquetFile(f).num_row_groups > 1 for f in files)
    assert spark.read.parquet(str(tmp_path / "landed")).distinct().count() == 200_000


def test_envelope(spark):
    df = spark.createDataFrame([(bytearray(b'{"ticker":"A","preco":"x","quantidade":3}'),), (bytearray(b"nope"),)], "Body binary")
    assert rows(readers.decode_envelope(df), "ticker", "preco", "quantidade") == [("A", None, 3), (None, None, None)]


def test_json_series(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"data":"01/02/2024","valor":"1.5"},\n{"data":"02/02/2024","valor":"x"}]')
    (tmp_path / "b.json").write_text("[]")
    (tmp_path / "c.json").write_text('[{"outra":"01/02/2024"}]')
    out = readers.read_series_json(spark, str(tmp_path), "selic", "2024-02-03", "hk")
    assert rows(out) == [("01/02/2024", 1.5, "selic", "2024-02-03", "hk")]


def test_nested_json(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"page":1},[{"date":"2020","value":1.5},{"date":"2021","value":null}]]')
    (tmp_path / "b.json").write_text('[{"message":"error"}]')
    out = readers.read_nested_json(spark, str(tmp_path), "pib_anual", "2024-02-03")
    assert rows(out, "ano", "valor", "indicador", "fonte") == [("2020", 1.5, "pib_anual", "world_bank")]


def test_masks(spark):
    df = spark.createDataFrame([("Silva", "123.456.789-09", "maria@exemplo.com")], "n string, c string, e string")
    assert rows(df.select(mask_name("n"), mask_cpf("c"), mask_email("e"))) == [("S****", "***.456.789-**", "ma***@exemplo.com")]


def test_hash_vectors(spark, monkeypatch):
    df = spark.createDataFrame([("cliente-123",)], "id string")
    expected = "66faf842c56abbb64f174125766cf094e8fb7f778a930430a36247e0e4f86901"
    assert df.select(salted_sha256("id", "salt-de-teste")).first()[0] == expected
    assert df.select(salted_sha256("id", "outro")).first()[0] != expected
    monkeypatch.delenv("LEDGERLAKE_SALT", raising=False)
    with pytest.raises(ValueError):
        pseudonymize(df, ["id"])
    monkeypatch.setenv("LEDGERLAKE_SALT", "salt-de-teste")
    assert pseudonymize(df, ["id"]).first()[0] == expected


def test_overwrite_merges_schema(spark, tmp_path):
    path = str(tmp_path / "t")
    tables.write_overwrite(spark.createDataFrame([(1, "a")], "id int, old string"), path)
    tables.write_overwrite(spark.createDataFrame([(2, 5)], "id int, new int"), path)
    assert rows(spark.read.parquet(path), "id", "old", "new") == [(2, None, 5)]


def test_landing_same_day_replaces(spark, tmp_path):
    base = str(tmp_path / "l")
    for value, day in ((1, "2024-01-01"), (2, "2024-01-02"), (3, "2024-01-02")):
        tables.write_landing(spark.createDataFrame([(value,)], "v int"), base, day)
    assert rows(tables.read_landing(spark, base)) == [(1, dt.date(2024, 1, 1)), (3, dt.date(2024, 1, 2))]


def test_snapshots(spark, tmp_path):
    path = str(tmp_path / "s")
    assert snapshots.list_versions(spark, path) == []
    with pytest.raises(FileNotFoundError):
        snapshots.read_current(spark, path)
    for ver, data in ((9, [("a", 1), ("b", 1)]), (10, [("a", 1), ("b", 2), ("c", 1)]), (11, [("a", None), ("c", 1)])):
        snapshots.write_snapshot(spark.createDataFrame(data, "k string, v int"), path, ver)
    with pytest.raises(Exception, match="already exists|PATH_ALREADY_EXISTS"):
        snapshots.write_snapshot(spark.createDataFrame([("a", 1)], "k string, v int"), path, 9)
    assert snapshots.list_versions(spark, path) == ["9", "10", "11"]
    assert rows(snapshots.read_current(spark, path), "k", "v") == [("a", None), ("c", 1)]
    snaps = snapshots.read_snapshots(spark, path)
    assert rows(snapshots.current_snapshot(snaps), "k", "v") == [("a", None), ("c", 1)]
    assert rows(snapshots.snapshot_asof(snaps, "ver", 10), "k") == [("a",), ("b",), ("c",)]
    assert rows(snapshots.changes_since(snaps, ["k"], start=9)) == [("c", 1)]
    assert rows(snapshots.changes_since(snaps, ["k"])) == [("a", 1), ("b", 1), ("c", 1)]
    kinds = ("insert", "update_preimage", "update_postimage", "delete")
    assert rows(snapshots.changes_since(snaps, ["k"], start=9, types=kinds, keep_meta=True)) == sorted([
        ("b", 1, "update_preimage", 10), ("b", 2, "update_postimage", 10), ("c", 1, "insert", 10),
        ("a", 1, "update_preimage", 11), ("a", None, "update_postimage", 11), ("b", 2, "delete", 11),
    ], key=repr)
    assert [tuple(r) for r in snapshots.snapshot_history(snaps, ["k"], limit=2).collect()] == [(11, 2, 0, 1, 1), (10, 3, 1, 1, 0)]


def test_failed_write_leaves_its_number_free(spark, tmp_path):
    path = str(tmp_path / "s")
    good = spark.createDataFrame([("a", 1)], "k string, v int")
    snapshots.write_snapshot(good, path, 1)
    with pytest.raises(Exception, match="broken"):
        snapshots.write_snapshot(good.select(F.raise_error(F.lit("broken")).cast("int").alias("v")), path, 2)
    assert snapshots.list_versions(spark, path) == ["1"]
    snapshots.write_snapshot(good, path, 2)
    assert snapshots.list_versions(spark, path) == ["1", "2"]
    assert rows(snapshots.read_current(spark, path), "k", "v") == [("a", 1)]


def test_consume_other_kinds(spark):
    snaps = spark.createDataFrame([("a", 1, 1), ("b", 1, 1), ("a", 2, 2), ("c", 5, 2)], "k string, v int, ver int")
    offsets = spark.createDataFrame([("gold", 1)], "consumidor string, versao int")
    kinds = (snapshots.INSERT, snapshots.PREIMAGE, snapshots.POSTIMAGE, snapshots.DELETE)
    got, _ = snapshots.consume_changes(snaps, offsets, "gold", lambda d: d, ["k"], types=kinds, keep_meta=True)
    assert rows(got) == [
        ("a", 1, "update_preimage", 2), ("a", 2, "update_postimage", 2), ("b", 1, "delete", 2), ("c", 5, "insert", 2)
    ]


def test_consume(spark):
    snaps = spark.createDataFrame([("a", 1), ("a", 2), ("b", 2)], "k string, ver int")
    offsets = spark.createDataFrame([], "consumidor string, versao int")
    first, offsets = snapshots.consume_changes(snaps, offsets, "gold", lambda d: d, ["k"])
    assert rows(first) == [("a",), ("b",)] and rows(offsets) == [("gold", 2)]
    nothing, same = snapshots.consume_changes(snaps, offsets, "gold", lambda d: d, ["k"])
    assert nothing is None and rows(same) == [("gold", 2)]
    behind = spark.createDataFrame([("gold", 1)], "consumidor string, versao int")
    assert rows(snapshots.consume_changes(snaps, behind, "gold", lambda d: d, ["k"])[0]) == [("b",)]
    assert rows(snapshots.consume_changes(snaps, behind, "other", lambda d: d, ["k"])[0]) == [("a",), ("b",)]


def test_compaction(spark, tmp_path):
    src, dst = str(tmp_path / "a"), str(tmp_path / "b")
    df = spark.range(2000).select(F.when(F.col("id") < 1500, 7).otherwise(F.col("id")).alias("k"), "id")
    df.repartition(16).write.parquet(src)
    snapshots.rewrite_clustered(spark.read.parquet(src), dst, ["k"], 4)
    out = spark.read.parquet(dst)
    assert rows(out) == rows(df)
    per_file = out.groupBy(F.input_file_name().alias("f")).agg(F.count("*").alias("n"), F.min("k"), F.max("k")).collect()
    assert len(per_file) == 4 and max(r["n"] for r in per_file) < 1200  # the value 7 is cut over files


def test_reconcile_multiplicity(spark):
    a = spark.createDataFrame([(1,)] * 5 + [(None,)] * 2 + [(2,)], "x int")
    b = spark.createDataFrame([(1,)] * 2 + [(2,)] + [(3,)], "x int")
    only_a, only_b = reconcile(a, b)
    assert rows(only_a) == [(1,), (1,), (1,), (None,), (None,)] and rows(only_b) == [(3,)]
    df = spark.createDataFrame([("a", 7), ("b", 1)], "k string, n long")
    assert rows(_replicate(df, F.col("n"), ["k"], chunk=3)) == [("a",)] * 7 + [("b",)]


def test_union_extracts(spark):
    a = spark.createDataFrame([(1, "x")], "id int, a string")
    b = spark.createDataFrame([(2, 3.0)], "id int, b double")
    assert rows(readers.union_extracts(a, None, b)) == [(1, "x", None), (2, None, 3.0)]
    with pytest.raises(ValueError):
        readers.union_extracts(None)


def test_scratch_follows_the_session(spark):
    root = spark.conf.get("spark.checkpoint.dir", None)
    assert scratch.scratch_dir(spark, "x").startswith(root or scratch.scratch_root(spark))
