"""Readers and writers on small files."""

import gzip
import json

import pytest

from tallyloom.sources import annotations, fastq, readers, sinks


def test_mtx_roundtrip(spark, tmp_path):
    (tmp_path / "m.mtx").write_text("%%MatrixMarket matrix coordinate real general\n%c\n2 3 3\n1 1 5\n2 3 7\n2 2 0\n")
    (tmp_path / "r.txt").write_text("AAA\nCCC\n")
    (tmp_path / "c.txt").write_text("g1_S\ng1_U\ng2_A\n")
    x = readers.read_mtx(spark, *(str(tmp_path / f) for f in ("m.mtx", "r.txt", "c.txt")), "run1")
    assert sorted(map(tuple, x.collect())) == [("run1", "AAA", "g1_S", 5.0), ("run1", "CCC", "g2_A", 7.0)]


def test_tables(spark, tmp_path):
    (tmp_path / "a.csv").write_text("id,x\na,1\nb,oops\n")
    (tmp_path / "b.csv").write_text("id,y\nc,2\n")
    (tmp_path / "e.csv").write_text("")
    got = readers.read_table(spark, str(tmp_path / "a.csv"), "id string, x int").collect()
    assert [r["x"] for r in got] == [1, None]
    assert readers.read_many(spark, [str(tmp_path / f) for f in ("a.csv", "b.csv", "e.csv")]).count() == 3
    assert readers.scan_distinct(spark, str(tmp_path / "a.csv"), ["id"]).count() == 2
    assert readers.read_headerless(spark, str(tmp_path / "b.csv"), ["p", "q"]).columns == ["p", "q"]
    (tmp_path / "s1.json").write_text(json.dumps({"n": 4}))
    r = readers.json_stats(spark, str(tmp_path / "s1.json"), ["n", "absent"]).first()
    assert (r["run_id"], r["n"], r["absent"]) == ("s1", 4.0, 0.0)


def test_gtf_and_gmt(spark, tmp_path):
    (tmp_path / "g.gtf").write_text("#h\n" + "\n".join([
        'chr1\th\tgene\t11\t20\t.\t+\t.\tgene_id "E1"; gene_type "rRNA"; gene_name "A";',
        'chr1\th\texon\t11\t20\t.\t+\t.\tgene_id "E1";',
        'chr2\th\tgene\t5\t9\t.\t-\t.\tgene_id "E2"; gene_biotype "x";',
        'chr1\th\tgene\t1\t3\t.\t+\t.\tgene_id "E3"; gene_type "x"; gene_name "C";']) + "\n")
    g = annotations.gtf_genes(spark, str(tmp_path / "g.gtf")).collect()
    assert [r["gene_id"] for r in g] == ["C_E3", "A_E1", "E2_E2"] and g[1]["gene_type"] == "rRNA"
    (tmp_path / "s.gmt").write_text("P1\tdesc\tA\tB\nP2\tdesc\tC\n")
    assert annotations.read_gmt(spark, str(tmp_path / "s.gmt"), "set").count() == 3


@pytest.fixture
def reads(tmp_path):
    for name in ("s1_L1_R1.fastq.gz", "s1_L1_R2.fastq.gz", "s2_L1_R1.fastq.gz"):
        with gzip.open(tmp_path / name, "wt") as f:
            for i in range(20):
                f.write(f"@r{i}\n{'ACGT' * 7}\n+\n@@@@{'I' * 24}\n")
    return str(tmp_path)


def test_fastq(spark, reads):
    files = fastq.list_fastqs(spark, reads)
    assert files.count() == 3
    pairs = {r["run_id"]: r for r in fastq.pair_fastqs(files, spark.createDataFrame([("s1",), ("s2",), ("s9",)], "run_id string")).collect()}
    assert set(pairs) == {"s1", "s2"} and pairs["s1"]["mates_agree"] and not pairs["s2"]["mates_agree"]
    r = fastq.fastq_reads(spark, reads + "/s1_L1_R1.fastq.gz", 5).collect()
    assert len(r) == 5 and all(x["barcode"] == "ACGT" * 4 and x["read_length"] == 28 for x in r)


@pytest.mark.parametrize("best,length,fw,rc,want", [
    (["3v3"], 28, 9, 1, ("10xv3", "fw", "3v3")), (["5v3"], 28, 9, 1, ("10xv3", "rc", "5v3")),
    (["3v2", "5v1", "5v2"], 26, 9, 1, ("10xv2", "fw", "3v2")), (["3v2", "5v1", "5v2"], 26, 1, 9, ("10xv2", "rc", "5v1/5v2")), (["3v3"], 26, 9, 1, ("10xv2", "fw", "3v2"))])
def test_chemistry(spark, best, length, fw, rc, want):
    ov = spark.createDataFrame([(c, f"{best[0]}.txt" if c in best else f"{c}.txt", 0.9 if c in best else 0.1) for c in fastq.CHEMISTRY_FAMILIES],
                               "chemistry string, gex_barcodes_f string, overlap double")
    r = fastq.detect_chemistry(ov, length, fw, rc).first()
    assert (r["layout"], r["orientation"], r["sample_chemistry"]) == want and not r["low_overlap"]


def test_sinks(spark, tmp_path):
    c = spark.createDataFrame([("b1", "c1", "g1", "S", 1.0), ("b1", "c1", "g1", "U", 2.0), ("b2", "c2", "g1", "S", 3.0)], "batch string, cell_id string, gene_id string, splice string, count double")
    sinks.write_counts_by_batch(c, str(tmp_path / "o"))
    assert [r["count"] for r in readers.read_clean_batch(spark, str(tmp_path / "o"), "b1").collect()] == [3.0]
    cells = spark.createDataFrame([("c1", "b1", None), ("c2", "b2", "x")], "cell_id string, batch string, note string")
    integ = spark.createDataFrame([("c1", False, False, "cl01"), ("c2", True, False, "cl01")], "cell_id string, is_dbl boolean, in_dbl_cl boolean, cluster string")
    r = sinks.clean_cells(cells, integ).collect()
    assert len(r) == 1 and r[0]["note"] == ""
    sinks.export_clean_batches(c.drop("batch"), cells, c.select("gene_id").distinct(), integ, str(tmp_path / "x"))
    assert spark.read.parquet(str(tmp_path / "x" / "counts")).count() == 1
    sinks.write_table(cells, str(tmp_path / "t"), "csv")
    t = spark.createDataFrame([("r1", "g1"), ("r2", "g1")], "run string, gene string")
    assert sinks.merge_identical(t, "run").count() == 1
    with pytest.raises(Exception):
        sinks.merge_identical(t.unionByName(spark.createDataFrame([("r2", "g2")], "run string, gene string")), "run")
    m = sinks.run_manifest(spark.createDataFrame([("r1", ["a", "b"])], "run_id string, batches array<string>"), "/in/%s", "/out/%s")
    assert m.count() == 2 and sinks.empty_result(spark, "a int").count() == 0
