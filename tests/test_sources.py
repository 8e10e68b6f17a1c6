import json

import pytest
from pyspark.sql import functions as F

from massquarry.operators import spectra
from massquarry.sources import artifacts, records
from massquarry.streaming import ingest


def test_tabular_smi_and_sdf(spark, tmp_path):
    (tmp_path / "a.csv").write_text('id,smi,f,note\n1,CCO,C2H6O,"x, y"\n2,,C,\n')
    cfg = tmp_path / "c.json"
    cfg.write_text(json.dumps({"name": "A", "path": str(tmp_path / "a.csv"), "format": "csv", "smiles": "smi", "id": "id", "formula": "f", "metadata": ["note"]}))
    r = records.read_records(spark, records.load_source_config(str(cfg))).orderBy("source_id").collect()
    assert [x.raw_smiles for x in r] == ["CCO", None] and json.loads(r[0].source_metadata) == {"note": "x, y"} and r[0].source == "A"
    (tmp_path / "b.smi").write_text("SMILES name\nCCO ethanol\n\nC methane gas\n")
    r = records.read_records(spark, records.SourceConfig("B", str(tmp_path / "b.smi"), "smi")).collect()
    assert [(x.raw_smiles, x.source_id) for x in r] == [("CCO", "ethanol"), ("C", "methane gas")]
    (tmp_path / "c.sdf").write_text("mol1\n  x\n\nM  END\n> <SMILES>\nCCO\n\n> <FORMULA>\nC2H6O\n\n$$$$\nmol2\n\n\nM  END\n$$$$\n")
    r = records.read_records(spark, records.SourceConfig("C", str(tmp_path / "c.sdf"), "sdf", smiles="SMILES", formula="FORMULA")).collect()
    assert [(x.source_id, x.raw_smiles, x.source_formula) for x in r] == [("mol1", "CCO", "C2H6O"), ("mol2", None, None)]
    with pytest.raises(FileNotFoundError):
        records.read_records(spark, records.SourceConfig("D", str(tmp_path / "none.smi"), "smi"))
    with pytest.raises(ValueError):
        records.SourceConfig("E", "x", "xls")


def test_mgf_and_peaks(spark, tmp_path):
    (tmp_path / "s.mgf").write_text("BEGIN IONS\nTITLE=a\nPEPMASS=300.5 1000\nCHARGE=1+\n100.1 5\n200.2\t7e1\nEND IONS\n\nBEGIN IONS\nTITLE=b\nEND IONS\n")
    r = records.read_mgf(spark, str(tmp_path / "s.mgf")).collect()
    assert r[0].headers["TITLE"] == "a" and r[0].precursor_mz == 300.5 and r[0].mzs == [100.1, 200.2] and r[0].intensities == [5.0, 70.0] and r[1].mzs == []
    df = spark.createDataFrame([("100.1:5;200.2:7",), (None,)], "p string")
    m, i = records.peak_lists(F.col("p"), "text")
    assert [tuple(x) for x in df.select(m, i).collect()] == [([100.1, 200.2], [5.0, 7.0]), (None, None)]
    t = spark.createDataFrame([(1, [1.0], [2.0], "x")], "Spectrum_ID long, `MS2 mzs` array<double>, intensities array<double>, adduct string")
    assert records.guess_roles(t) == {"adduct": "adduct", "mzs": "MS2 mzs", "intensities": "intensities", "id": "Spectrum_ID"}


def test_artifacts(spark, tmp_path):
    p, made = str(tmp_path / "t"), []
    build = lambda: made.append(1) or spark.range(5)
    assert artifacts.cached(spark, p, build, {"a": 1}).count() == 5 and artifacts.cached(spark, p, build, {"a": 1}).count() == 5 and len(made) == 1
    artifacts.cached(spark, p, build, {"a": 2})
    assert len(made) == 2 and artifacts.artifact_metadata(spark, p)["rows"] == 5
    b = str(tmp_path / "b")
    df = spark.createDataFrame([("AAB", 1), ("ABC", 2), ("ZZZ", 3), (None, 4)], "k string, v int")
    artifacts.write_bucketed(df, b, "k")
    assert [r.v for r in artifacts.read_by_keys(spark, b, df.where("v in (1, 3)"), "k").orderBy("v").collect()] == [1, 3]
    r = str(tmp_path / "r")
    artifacts.upsert(spark, r, spark.createDataFrame([("e1", 1.0), ("e2", 2.0)], "id string, m double"), "id")
    assert {x.id: x.m for x in artifacts.upsert(spark, r, spark.createDataFrame([("e1", 5.0)], "id string, m double"), "id").collect()} == {"e1": 5.0, "e2": 2.0}
    artifacts.append_log(spark, str(tmp_path / "log"), {"decision": "x"})
    artifacts.append_log(spark, str(tmp_path / "log"), {"decision": "y"})
    assert artifacts.read_log(spark, str(tmp_path / "log"), "decision string, at string, old string").count() == 2
    sub = spark.createDataFrame([("m1", "C;CC"), ("m2", ""), ("m3", "C;C")], "molecule_id string, smiles string")
    v = artifacts.validate_submission(sub, spark.createDataFrame([("m1",), ("m2",), ("m4",)], "molecule_id string")).first()
    assert (v.rows, v.empty, v.repeated, v.missing, v.unknown) == (3, 1, 1, 1, 1)
    with pytest.raises(ValueError, match="refused"):
        artifacts.write_submission(sub, sub.select("molecule_id"), str(tmp_path / "s"))
    ok = sub.where("molecule_id = 'm1'")
    artifacts.write_submission(ok, ok.select("molecule_id"), str(tmp_path / "s"))
    assert spark.read.csv(str(tmp_path / "s"), header=True).first().smiles == "C;CC"


def test_stream_takes_every_file_once(spark, tmp_path):
    src, dst, ck = (str(tmp_path / n) for n in ("src", "dst", "ck"))
    rows = [(k, 300.0, [100.0, 200.0], [1.0, float(k)]) for k in range(20)] + [(99, None, None, None)]
    df = spark.createDataFrame(rows, "row_offset long, precursor_mz double, ms2_mzs array<double>, ms2_normalized_intensities array<double>")
    df.repartition(3).write.parquet(src)
    for _ in range(2):
        ingest.ingest(spark, src, dst, ck).awaitTermination(120)
    assert spark.read.parquet(dst).count() == 21
    df.write.mode("append").parquet(src)
    ingest.ingest(spark, src, dst, ck).awaitTermination(120)
    got = spark.read.parquet(dst)
    assert got.count() == 42 and got.columns == ingest.spectrum_features(df).columns
    assert spectra.FLAGS == tuple(c[5:] for c in got.columns if c.startswith("flag_"))
