import pytest
from pyspark.sql import functions as F

from gridloom import api
from gridloom.model import Dataset
from gridloom.operators import merge, qc
from gridloom.sources import archives, collections, files


def folder(base, name, barcodes, genes, entries):
    d = base / name
    d.mkdir()
    (d / "barcodes.tsv").write_text("\n".join(barcodes) + "\n")
    (d / "features.tsv").write_text("\n".join(f"ENS{k}\t{g}\tGene Expression" for k, g in enumerate(genes)) + "\n")
    (d / "matrix.mtx").write_text("%%MatrixMarket matrix coordinate integer general\n%\n" + f"{len(genes)} {len(barcodes)} {len(entries)}\n" + "\n".join(" ".join(map(str, e)) for e in entries) + "\n")


def test_matrix_folders(spark, tmp_path):
    folder(tmp_path, "S1_raw", ["AA", "BB"], ["G1", "G2"], [(1, 1, 3), (2, 1, 1), (2, 2, 5)])
    folder(tmp_path, "S2_raw", ["AA"], ["G1", "G2"], [(1, 1, 0), (2, 1, 7)])
    obs, counts = files.read_matrix_folders(spark, f"{tmp_path}/*_raw", "_raw")
    assert sorted(r.cell_id for r in obs.collect()) == ["S1_AA", "S1_BB", "S2_AA"]
    assert sorted((r.cell_id, r.gene_id, r.value) for r in counts.collect()) == [("S1_AA", "G1", 3.0), ("S1_AA", "G2", 1.0), ("S1_BB", "G2", 5.0), ("S2_AA", "G2", 7.0)]


def test_gene_sets_and_modules(spark, tmp_path):
    (tmp_path / "a.gmt").write_text("S1\tx\tG1\tG2\tG1\nS2\tx\tG3\nshort\tx\nS1\tx\tG4\n")
    assert [(r.source, r.target, r.ord) for r in files.read_gmt(spark, str(tmp_path / "a.gmt")).orderBy("source", "ord").collect()] == [("S1", "G1", 1), ("S1", "G2", 2), ("S1", "G4", 3), ("S2", "G3", 1)]
    (tmp_path / "m.tsv").write_text("Signature\tSymbol\nA\tG1\nA\tG2\n")
    (tmp_path / "mine.txt").write_text("# note\nG1\n\nG9\n")
    assert sorted(tuple(r) for r in files.read_modules(spark, str(tmp_path / "m.tsv")).collect()) == [("A", "G1"), ("A", "G2")]
    assert sorted(tuple(r) for r in files.read_modules(spark, str(tmp_path / "mine.txt")).collect()) == [("mine", "G1"), ("mine", "G9")]


def test_mappings(spark, tmp_path):
    (tmp_path / "r.tsv").write_text("# c\nC00\tOne\nC01\tTwo\n")
    assert sorted(tuple(r) for r in files.read_mapping(spark, str(tmp_path / "r.tsv"), ("code", "label"), True).collect()) == [("C00", "One"), ("C01", "Two")]
    (tmp_path / "bad.tsv").write_text("X0\tOne\n")
    with pytest.raises(ValueError):
        files.read_mapping(spark, str(tmp_path / "bad.tsv"), ("code", "label"), True)


def test_gene_types(spark):
    rows = spark.createDataFrame([("MT-CO1",), ("LINC01",), ("SNORD3",), ("ACTB",)], "g string")
    assert [r[0] for r in rows.select(files.gene_type_from_name(F.col("g"))).collect()] == ["Mt", "lincRNA", "snoRNA", "protein_coding"]


def dataset(spark):
    cells = [(f"c{k}", "A" if k < 30 else "B", "C00: x" if k % 2 else "C01: y") for k in range(60)]
    obs = spark.createDataFrame(cells, "cell_id string, sample_id string, label string")
    counts = spark.createDataFrame([(c, f"g{m}", "counts_raw", float(1 + (k * m) % 5)) for k, (c, _, _) in enumerate(cells) for m in range(8) if (k + m) % 3], files.COUNTS)
    var = spark.createDataFrame([(f"g{m}",) for m in range(8)], "gene_id string")
    return Dataset(obs, var, counts, {"My table": spark.createDataFrame([(1,)], "x int")})


def test_round_trip(spark, tmp_path):
    data = dataset(spark)
    files.save_dataset(data, str(tmp_path / "d"))
    again = files.load_dataset(spark, str(tmp_path / "d"))
    assert sorted(map(tuple, again.counts.collect())) == sorted(map(tuple, data.counts.collect()))
    assert again.tables["My table"].collect()[0].x == 1 and again.layer().columns == ["cell_id", "gene_id", "value"]
    files.save_dataset(Dataset(data.obs, data.var, data.counts, {"a b": data.obs, "A_b": data.var}), str(tmp_path / "e"))
    again = files.load_dataset(spark, str(tmp_path / "e"))
    assert again.tables["a b"].count() == 60 and again.tables["A_b"].count() == 8


def test_samples_with_calling_and_barcodes(spark, tmp_path):
    cells = [f"B{k}" for k in range(40)]
    for name in ("S1", "S2"):
        folder(tmp_path, f"{name}_raw", cells, ["G1", "G2"], [(1 + k % 2, k + 1, 2000 + 300 * k if k < 12 else 1 + k % 3) for k in range(40)])
    assert set(files.sample_folders(spark, f"{tmp_path}/*_raw", "_raw")) == {"S1", "S2"}
    obs, counts, totals = files.load_samples(spark, f"{tmp_path}/*_raw", "_raw", call=True)
    kept = {r.cell_id for r in obs.collect()}
    assert kept == {r.cell_id for r in counts.select("cell_id").distinct().collect()} and 4 <= len(kept) <= 24 and all(int(c.split("_B")[1]) < 12 for c in kept)
    row = {r.sample_id: r for r in totals.collect()}["S1"]
    assert row.n_cells == len(kept) / 2 and row.counts_before == sum(2000 + 300 * k if k < 12 else 1 + k % 3 for k in range(40)) > row.counts_after
    for name in ("S1", "S2"):
        (tmp_path / f"{name}_barcodes.csv").write_text("B1,x\nB2\n\nZZ\n")
    listed = files.read_barcodes(spark, f"{tmp_path}/*_barcodes.csv", "_barcodes.csv")
    obs, counts, totals = files.load_samples(spark, f"{tmp_path}/*_raw", "_raw", layer="counts_cb", barcodes=listed)
    assert sorted(r.cell_id for r in obs.collect()) == ["S1_B1", "S1_B2", "S2_B1", "S2_B2"] and {r.layer for r in counts.collect()} == {"counts_cb"}
    with pytest.raises(ValueError, match="S2"):
        files.load_samples(spark, f"{tmp_path}/*_raw", "_raw", barcodes=listed.where("sample_id = 'S1'"))
    with pytest.raises(FileNotFoundError):
        files.load_samples(spark, f"{tmp_path}/none*")


def test_archives(tmp_path):
    (tmp_path / "d" / "sub").mkdir(parents=True)
    (tmp_path / "d" / "sub" / "x.txt").write_text("content " * 1000)
    archive = archives.pack(str(tmp_path / "d"), str(tmp_path / "d.tar.zst"))
    assert "d/sub/x.txt" in archives.members(archive)
    out = archives.unpack(archive, str(tmp_path / "out"))
    assert out == str(tmp_path / "out" / "d") and (tmp_path / "out" / "d" / "sub" / "x.txt").read_text() == "content " * 1000
    for bad in ("/etc/passwd", "a/../../b", "..\\x"):
        with pytest.raises(ValueError):
            archives.check_members(["fine", bad])
    (tmp_path / "d" / "link").symlink_to("/etc/passwd")
    with pytest.raises(ValueError):
        archives.unpack(archives.pack(str(tmp_path / "d"), str(tmp_path / "e.tar.zst")), str(tmp_path / "out2"))


def test_collections(tmp_path):
    for name in ("h.all.v2024.1.Hs.symbols.gmt", "h.all.v2025.1.Hs.symbols.gmt", "c2.cp.reactome.v2025.1.Hs.symbols.gmt", "c5.go.bp.v2025.1.Hs.symbols.gmt"):
        (tmp_path / name).write_text("S\tx\tG\n")
    (tmp_path / "own.gmt").write_text("S\tx\tG\n")
    assert collections.keywords(str(tmp_path)) == ["BP", "C2_CP_REACTOME", "C5_GO_BP", "HALLMARK", "H_ALL", "REACTOME"]
    paths, used, release = collections.resolve(None, str(tmp_path))
    assert [p.rsplit("/", 1)[1] for p in paths] == ["h.all.v2025.1.Hs.symbols.gmt", "c2.cp.reactome.v2025.1.Hs.symbols.gmt"] and used == ["HALLMARK", "REACTOME"] and release == "2025.1.Hs"
    assert collections.resolve(f"{tmp_path}/own.gmt, nothing", str(tmp_path))[2] is None
    assert len(collections.resolve(["hallmark", "H_ALL"], str(tmp_path))[0]) == 1
    for bad in ("nothing", [], " , "):
        with pytest.raises(ValueError):
            collections.resolve(bad, str(tmp_path))
    (tmp_path / "Immune.pkl").write_text("")
    assert list(collections.models(str(tmp_path))) == ["Immune"]


def test_result_folders(spark, tmp_path):
    one = tmp_path / "pb" / "condition_within_cluster__sex"
    one.mkdir(parents=True)
    (one / "condition_within_cluster__C00__F_vs_M.csv").write_text("gene,stat\ng1,2\n")
    (one / "condition_within_cluster__C01.csv").write_text("gene,stat\ng2,1\n")
    (one / "__summary.csv").write_text("gene,stat\nno,1\n")
    assert sorted((r.condition_key, r.cluster, r.contrast, r.gene) for r in files.read_pseudobulk_folder(spark, str(tmp_path / "pb")).collect()) == [("sex", "C00", "F_vs_M", "g1"), ("sex", "C01", "contrast", "g2")]
    two = tmp_path / "cell" / "sex_F_vs_M_DE" / "tables"
    two.mkdir(parents=True)
    for cluster, kind, gene in (("C00", "wilcoxon", "w"), ("C00", "combined", "c"), ("C01", "logreg", "l"), ("C01", "pseudobulk_effect", "p")):
        (two / f"cluster__{cluster}__F_vs_M__{kind}.csv").write_text(f"gene,score\n{gene},1\n")
    found = files.read_cell_folder(spark, str(tmp_path / "cell")).collect()
    assert sorted((r.condition_key, r.contrast, r.cluster, r.kind, r.gene) for r in found) == [("sex", "F_vs_M", "C00", "combined", "c"), ("sex", "F_vs_M", "C01", "logreg", "l")]


def test_events_annotations_and_payloads(spark, tmp_path):
    (tmp_path / "e.tsv").write_text("sender\treceiver\tligand_complex\tReceptor\tlrscore\nC00\tC01\tA\tB\t0.5\n")
    assert tuple(files.read_events(spark, str(tmp_path / "e.tsv")).first()) == ("C00", "C01", "A", "B", "0.5")
    (tmp_path / "bad.csv").write_text("source,target,ligand\na,b,c\n")
    with pytest.raises(ValueError, match="receptor"):
        files.read_events(spark, str(tmp_path / "bad.csv"))
    (tmp_path / "genes.csv").write_text("Symbol,Gene_Biotype\nG1,lincRNA\nG1,antisense\n,x\n")
    assert [tuple(r) for r in files.read_gene_annotation(spark, str(tmp_path / "genes.csv")).collect()] == [("G1", "antisense", None, None)]
    table = spark.createDataFrame([("C00", "P", 1.5)], "cluster string, pathway string, score double")
    files.export_payloads({"msig db": {"activity": table, "activity_HALLMARK": table, "activity_REACTOME": table.limit(0)}}, str(tmp_path / "pay"))
    again = files.load_payloads(spark, str(tmp_path / "pay"))
    assert list(again) == ["msig_db"] and [tuple(r) for r in again["msig_db"]["activity"].collect()] == [("C00", "P", 1.5)]
    assert [r.collection for r in again["msig_db"]["activity_by_collection"].collect()] == ["HALLMARK"]
    data = dataset(spark)
    labels = data.obs.select(F.lit("r1").alias("round_id"), "cell_id", F.lit("C00").alias("cluster_id"))
    data.tables.update(rounds=spark.createDataFrame([("r0", False), ("r1", True)], "round_id string, active boolean"), round_labels=labels)
    files.export_annotations(data, str(tmp_path / "ann"), ["label", "absent"])
    rows = spark.read.csv(str(tmp_path / "ann"), header=True)
    assert rows.columns == ["cell_id", "label", "round_cluster"] and rows.where("round_cluster = 'C00'").count() == 60
    files.export_results(spark.createDataFrame([("sex", "F_vs_M", "C00", "g")], "condition_key string, contrast string, cluster string, gene string"), str(tmp_path / "res"))
    assert (tmp_path / "res" / "condition_key=sex" / "contrast=F_vs_M" / "cluster=C00").is_dir()


def test_api(spark, tmp_path):
    data = dataset(spark)
    kept, judged = api.load_and_filter(data, {"mt": F.col("gene_id") == "g0"}, min_genes=3, lower={"min_counts": 5})
    assert kept.obs.count() <= data.obs.count() and judged.count() == 60
    both = api.merge_datasets({"a": data, "b": data}, "inner")
    assert both.obs.count() == 120
    mapping = spark.createDataFrame([("C00", "one"), ("C01", "two")], "code string, subset string")
    assert {k: d.obs.count() for k, d in api.subset_by_cluster_mapping(data, mapping, "label").items()} == {"one": 30, "two": 30}
    renamed = api.rename_idents(data, spark.createDataFrame([("C00", "same"), ("C01", "same")], "code string, name string"), "label")
    assert [r.label for r in renamed.obs.select("label").distinct().collect()] == ["same"]
    (tmp_path / "n.gmt").write_text("H_one\tx\tg0\tg1\tg2\nH_two\tx\tg3\tg4\tg5\n")
    assert api.enrichment_cluster(data, "label", str(tmp_path / "n.gmt"), least=2).count() == 4
    scored, summary = api.module_score(data, str(tmp_path / "n.gmt"), "label", bins=2, controls=1)
    assert scored.count() == 60 and summary.count() == 4
    d = tmp_path / "de"
    d.mkdir()
    (d / "sex__F_vs_M__C00.csv").write_text("gene,log2FoldChange,score\ng0,0.2,5\ng1,,-3\ng2,1,1\ng3,-1,2\n")
    assert api.enrichment_de_from_tables(spark, str(d), str(tmp_path / "n.gmt"), least=1).count() >= 1


def test_validated_join(spark):
    obs = spark.createDataFrame([("c1", "s1"), ("c2", "s2")], "cell_id string, sample_id string")
    meta = lambda *rows: spark.createDataFrame(list(rows), "key string, sex string")
    assert merge.add_metadata(obs, meta(("s1", "f"), ("s2", "m")), "sample_id", "key").count() == 2
    for bad in (meta(("s1", "f"), ("s1", "f"), ("s2", "m")), meta(("s1", "f")), meta(("s1", "f"), ("s2", "m"), ("s3", "m")), meta(("s1", "f"), ("s2", None))):
        with pytest.raises(ValueError):
            merge.add_metadata(obs, bad, "sample_id", "key")
    assert merge.add_metadata(obs, meta(("s1", "f")), "sample_id", "key", exact=False, allow_missing=True).where("sex is null").count() == 1


def test_overlays_are_checked(spark):
    frame = lambda *rows: spark.createDataFrame(list(rows), "cell_id string, label string")
    parent = frame(("a", "x"), ("b", "x"), ("c", "y"))
    assert {r.cell_id: r.label for r in merge.overlay(parent, [frame(("a", "n"))], "label").collect()} == {"a": "n", "b": "x", "c": "y"}
    for bad in ([frame(("a", "n")), frame(("a", "m"))], [frame(("z", "n"))]):
        with pytest.raises(ValueError):
            merge.overlay(parent, bad, "label")


def matrix(spark, rows):
    obs = spark.createDataFrame([(f"c{k}", "A") for k in range(len(rows))], "cell_id string, sample_id string")
    counts = spark.createDataFrame([(f"c{k}", f"g{m}", float(x)) for k, r in enumerate(rows) for m, x in enumerate(r)], "cell_id string, gene_id string, value double")
    return qc.cell_metrics(counts, obs, {"mt": F.lit(False)})


@pytest.mark.parametrize("rows,lower,expected", [
    ([[1, 0, 0], [2, 2, 1], [5, 1, 0]], {"min_counts": 4, "mads": None}, ["c1", "c2"]),
    ([[1, 0, 0], [2, 2, 1], [5, 1, 0], [6, 2, 1]], {"mads": 5.0, "quantile": 0.25}, ["c1", "c2", "c3"]),
    ([[1100, 10, 0], [1200, 10, 0], [1300, 10, 0], [1400, 10, 0]], {"mads": 0.0, "quantile": 0.5}, ["c0", "c1", "c2", "c3"]),
])
def test_lower_cut(spark, rows, lower, expected):
    found = qc.cascade(matrix(spark, rows), ["sample_id"], min_genes=1, lower=lower)
    assert sorted(r.cell_id for r in found.where("failed_at is null").collect()) == expected
