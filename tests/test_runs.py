"""Whole runs and the commands on a stored dataset."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from gridloom import runs
from gridloom.__main__ import main
from gridloom.model import Dataset
from gridloom.sources import files


@pytest.fixture(scope="module")
def data(spark):
    """240 cells of 8 samples in two clusters; in C00 gene up rises with m, gene mark belongs to C01."""
    rng = np.random.default_rng(3)
    cells, counts = [], []
    for k in range(240):
        sample, cluster = k % 8, k // 8 % 3 == 0
        sex, site = "fm"[sample % 2], "xy"[sample // 2 % 2]
        cells.append((f"c{k:03d}", f"s{sample}", "C01: B" if cluster else "C00: A", sex, site))
        mean = {f"g{m}": 6 + m for m in range(6)} | {"up": 12 if sex == "m" and not cluster else 3, "mark": 10 if cluster else 1}
        counts += [(f"c{k:03d}", g, "counts_raw", float(n)) for g, v in mean.items() if (n := rng.poisson(v)) > 0]
    obs = spark.createDataFrame(cells, "cell_id string, sample_id string, label string, sex string, site string")
    var = spark.createDataFrame([(f"g{m}",) for m in range(6)] + [("up",), ("mark",)], "gene_id string")
    return Dataset(obs, var, spark.createDataFrame(counts, files.COUNTS))


@pytest.fixture(scope="module")
def stored(data, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("stored") / "d")
    files.save_dataset(data, path)
    return path


def test_differential(data):
    found = runs.differential(data, "label", "sex", contrasts=["m_vs_f"], least=30)
    assert {r.cluster: r.skip_reason for r in found["tasks"].collect()} == {"C00: A": None, "C01: B": None}
    cell = {(r.cluster, r.gene_id): r for r in found["cell"].collect()}
    assert cell["C00: A", "up"].padj < 1e-4 and cell["C00: A", "up"].lfc > 1 and cell["C01: B", "up"].padj > 0.01
    bulk = {(r.cluster, r.gene_id): r for r in found["pseudobulk"].collect()}
    assert abs(bulk["C00: A", "up"].log2fc - 2) < 0.5 and bulk["C00: A", "up"].padj < 0.01
    tiers = {(r.cluster, r.gene_id): r.tier for r in found["combined"].where("tier is not null").collect()}
    assert tiers["C00: A", "up"] in ("Tier1", "Tier2")
    few = runs.differential(data, "label", "sex", least=50, pseudobulk_tests=False)
    assert {r.cluster: r.skip_reason for r in few["tasks"].collect()}["C01: B"] == "too_few_cells"
    assert {r.cluster for r in few["cell"].collect()} == {"C00: A"}


def test_differential_within_and_across(data):
    within = runs.differential(data, "label", "sex@site", contrasts=["m_vs_f"], least=5, pseudobulk_tests=False)
    assert {r.cluster for r in within["cell"].select("cluster").distinct().collect()} == {f"{c} @ {s}" for c in ("C00: A", "C01: B") for s in "xy"}
    crossed = runs.differential(data, "label", "sex^site", contrasts=["m_vs_f"], second=("x", "y"))["interaction"]
    assert abs(crossed.where("cluster = 'C00: A' and gene_id = 'up'").first().log2fc) < 0.7
    with pytest.raises(ValueError):
        runs.differential(data, "label", "sex^site")


def test_markers_and_abundance(data):
    found = runs.markers(data, "label")
    assert {r.label: r.gene_id for r in found["cell"].where("rank = 1").collect()}["C01: B"] == "mark"
    assert found["pseudobulk"].where("cluster = 'C01: B'").orderBy("pval").first().gene_id == "mark"
    tables = runs.abundance(data, "label", "sample_id", "sex", "f")
    assert {r.method for r in [*tables["glm"].withColumn("method", F.lit("glm")).collect()]} == {"glm"} and tables["consensus"].count() == 2
    assert tables["table"].count() == 16 and {r.n_methods for r in tables["consensus"].collect()} == {2}
    with pytest.raises(ValueError):
        runs.abundance(data, "label", "sample_id", "sex", "f", least_samples=9)


def test_signalling(data, spark):
    pairs = spark.createDataFrame([("up", "mark"), ("g1", "g2")], "ligand string, receptor string")
    found = runs.signalling(data, "label", pairs, n_perms=50)
    assert found["scores"].count() == 8 and {"magnitude_rank", "specificity_rank"} <= set(found["scores"].columns) and found["summary"].count() == 4
    by = runs.signalling(data, "label", pairs, condition="sex@site")
    assert by["scores"].select("context", "level").distinct().count() == 4
    events = found["scores"].select("source", "target", "ligand", "receptor", "lrscore")
    display = data.obs.select("label").distinct().withColumn("cluster", F.col("label"))
    paired = runs.paired_signalling(data, "label", "sample_id", "sex", ("m", "f"), events, display, allow={"ligand": ["up"]})
    effects = {r.event: r for r in paired["effects"].collect()}
    chosen = {r.event: r.source_token for r in paired["events"].collect()}
    assert set(chosen) == set(effects) and all(effects[e].delta > 0.1 for e, s in chosen.items() if s == "C00: A")
    with pytest.raises(ValueError):
        runs.paired_signalling(data, "label", "sample_id", "sex", ("m", "f"), events.withColumn("source", F.lit("C9")), display)
    asked = spark.createDataFrame([(1, "C00: A", "C01: B", "M", "mark", "up; g1")], "event long, source string, target string, metabolite string, sensor string, genes string")
    mets = runs.paired_metabolites(data, "label", "sample_id", "sex", ("m", "f"), asked, annotation=spark.createDataFrame([("M", "lipid")], "metabolite string, class string"))
    assert mets["effects"].first().delta > 0 and tuple(mets["classes"].first())[:2] == ("lipid", 8)
    targets = spark.createDataFrame([("up", g, float(g in ("up", "g1"))) for g in ("up", "mark", "g1", "g2")] + [("g1", g, float(g == "mark")) for g in ("up", "mark", "g1", "g2")], "ligand string, gene_id string, score double")
    links = runs.ligand_targets(data, "label", "C00: A", "C00: A", pairs, targets, level="sex", pair=("m", "f"), least_gap=0.02)
    assert [r.gene_id for r in links["geneset"].collect()] == ["up"] and links["activities"].first().ligand == "up" and links["links"].first().gene_id == "up"


def test_enrichment(data, spark, tmp_path):
    (tmp_path / "n.gmt").write_text("one\tx\tg0\tg1\tup\ntwo\tx\tg3\tg4\tmark\n")
    found = runs.enrich_clusters(data, "label", [str(tmp_path / "n.gmt")], condition="sex", methods=("ulm", "wsum", "mlm"), least=2, round_id="r1")
    assert found["activity"].count() == 8 and {r.source for r in found["activity"].collect()} == {"n::one", "n::two"} and "round_id" in found["activity"].columns
    d = tmp_path / "pb" / "condition_within_cluster__sex"
    d.mkdir(parents=True)
    (d / "condition_within_cluster__C00__m_vs_f.csv").write_text("gene,stat\n" + "\n".join(f"{g},{x}" for g, x in (("up", 9), ("g0", 2), ("g1", 1), ("g2", 0), ("g3", -1), ("g4", -2), ("mark", -4))) + "\n")
    tables = runs.enrich_result_folder(spark, str(tmp_path / "pb"), [str(tmp_path / "n.gmt")], least=2, permutations=100)
    rows = {r.pathway: r for r in tables["joint"].collect()}
    assert rows["n::one"].nes > 0 > rows["n::two"].nes and all(r.sign_concordant for r in rows.values())
    with pytest.raises(FileNotFoundError):
        runs.enrich_result_folder(spark, str(tmp_path / "nothing"), [str(tmp_path / "n.gmt")])


def test_merge_by_tokens(data, spark):
    parts, display = runs.merge_tokens({"a": data, "b": data}, spark.createDataFrame([("a", "C01")], "dataset string, token string"), "label")
    assert {k: d.obs.count() for k, d in parts.items()} == {"a": 80, "b": 240}
    assert [(r.composite, r.code) for r in display.orderBy("code").collect()] == [("b: C00: A", "C00"), ("a: C01: B", "C01"), ("b: C01: B", "C02")]
    with pytest.raises(ValueError):
        runs.merge_tokens({"a": data}, spark.createDataFrame([("a", "C7")], "dataset string, token string"), "label")


def test_commands(stored, spark, tmp_path, capsys):
    out = lambda name: str(tmp_path / name)
    (tmp_path / "m.tsv").write_text("C00\tone\nC01\ttwo\n")
    assert main(["list"]) == 0 and "qc_cascade *" in capsys.readouterr().out
    main(["subset", "--data", stored, "--mapping", out("m.tsv"), "--label", "label", "--out", out("sub")])
    assert files.load_dataset(spark, out("sub/two")).obs.count() == 80
    main(["rename", "--data", stored, "--mapping", out("m.tsv"), "--label", "label", "--out", out("ren")])
    assert {r.label for r in files.load_dataset(spark, out("ren")).obs.select("label").distinct().collect()} == {"one", "two"}
    main(["annotation-merge", "--data", stored, "--child", out("sub/two"), "--label", "label", "--out", out("ann")])
    main(["merge", "--part", out("sub/one"), "--part", out("sub/two"), "--out", out("mer"), "--how", "inner"])
    assert files.load_dataset(spark, out("mer")).obs.count() == 240
    (tmp_path / "meta.csv").write_text("sample,age\n" + "\n".join(f"s{k},{k}" for k in range(8)) + "\n")
    main(["metadata-import", "--data", stored, "--metadata", out("meta.csv"), "--out", out("met")])
    assert "age" in files.load_dataset(spark, out("met")).obs.columns
    main(["de", "--data", stored, "--cluster", "label", "--condition", "sex", "--contrast", "m_vs_f", "--least", "10", "--out", out("de")])
    assert spark.read.parquet(out("de/combined")).count() > 0
    main(["markers", "--data", stored, "--cluster", "label", "--out", out("mark")])
    main(["da", "--data", stored, "--cluster", "label", "--condition", "sex", "--reference", "f", "--out", out("da")])
    (tmp_path / "lr.csv").write_text("ligand,receptor\nup,mark\n")
    main(["ligand-receptor", "--data", stored, "--group", "label", "--pairs", out("lr.csv"), "--permutations", "20", "--out", out("lr")])
    assert spark.read.parquet(out("lr/scores")).count() == 4
    (tmp_path / "n.gmt").write_text("one\tx\tg0\tg1\tg2\tg3\tup\n")
    main(["enrichment-cluster", "--data", stored, "--group", "label", "--sets", out("n.gmt"), "--out", out("enr")])
    main(["module-score", "--data", stored, "--group", "label", "--modules", out("n.gmt"), "--out", out("mod")])
    main(["genes", "--data", stored, "--filter", "gene_type == 'protein_coding' and gene_id != 'up'", "--out", out("genes")])
    assert spark.read.parquet(out("genes")).count() == 7
    main(["archive", "--data", stored, "--out", out("d.tar.zst")])
    main(["archive", "--data", out("d.tar.zst"), "--out", out("back")])
    assert files.load_dataset(spark, out("back/d")).obs.count() == 240
