"""Whole runs against fixtures and against a brute-force matcher."""

import json
import random

import pytest
from pyspark.sql import functions as F

from strandloom.operators import combine, reads, results, windows
from strandloom.operators.targets import prepare_targets
from strandloom.plans import pipeline
from strandloom.plans.config import MatchConfig


def target_table(spark, rows):
    return prepare_targets(spark.createDataFrame([(k, n, s) for k, (n, s) in enumerate(rows)], "number long, name string, seq string"))


def a_run(spark, read_rows, target_rows, **settings):
    options = {k: settings.pop(k) for k in ("start", "strict", "compat") if k in settings}
    config = MatchConfig(**{"Windows": (0, 5), "WindowWidth": 4, "PMatch": 1.0, "MaxReadLength": 300, "MaxMatches": 1000, "MatchMode": "best", "BloomSize": 1000, "NumHash": 5} | settings)
    return pipeline.Run(spark, config, spark.createDataFrame(read_rows, "name string, seq string"), target_table(spark, target_rows), **options)


def brute(read_rows, target_rows, starts, width, share, tolerance, dinuc=0):
    """Distinct matches of the best of each read, without a limit."""
    clean = lambda s: "".join(c if c in "ACGT" else "X" for c in s)
    found = {}
    for _, r in read_rows:
        r = clean(r)
        for name, t in target_rows:
            t = clean(t)
            for pos in range(len(t) - len(r) + 1):
                sub = t[pos : pos + len(r)]
                miss = sum(x != y for x, y in zip(r, sub))
                hit = any(q + width <= len(r) and r[q : q + width] == sub[q : q + width] and len({r[q + i : q + i + 2] for i in range(width - 1)}) >= dinuc for q in starts)
                if hit and miss <= int((1 - share) * float(len(r))):
                    found.setdefault(r, set()).add((r, sub, pos, miss, name, len(t)))
    return sorted(x for v in found.values() for x in v if x[3] <= min(y[3] for y in v) + tolerance)


FILLER = "T" * 20
GENES = [("gene%d" % k, FILLER) for k in range(10)]
GENES[3], GENES[5], GENES[7] = ("gene3", "T" * 10 + "GTAGGATATC"), ("gene5", "CGGCTTACGG" + "T" * 10), ("gene7", "T" * 10 + "AGTTCAGCCA")
READS = [(">read1_matching", "GTAGGATATC"), (">read2_matching", "CGGCTTACGG"), (">read3_matching", "AGTTCAGCCA"), (">read4", "GTACGCATCC"), (">read5", "TTATTATGCG"), (">read6", "GCCGCTACGA")]


def test_end_to_end_files(spark, tmp_path):
    (tmp_path / "reads.fastq").write_text("".join(f"{n}\n{s}\n+\n{'!' * len(s)}\n" for n, s in READS))
    (tmp_path / "genes.txt").write_text("".join(f"{n}\t{s}\n" for n, s in GENES))
    sequences, ids = pipeline.prepare(spark, str(tmp_path / "genes.txt"))
    settings = {"readfilename": str(tmp_path / "reads.fastq"), "GeneFileName": sequences, "GeneIdFileName": ids, "ResultsFileName": str(tmp_path / "result.txt"), "Windows": [0, 5], "WindowWidth": 4, "BloomSize": 4000000, "NumHash": 20, "PMatch": 1, "MinDinuc": 1, "MaxReadLength": 300, "MaxMatches": 1000, "MatchMode": "best", "MMTol": 1, "TempDir": str(tmp_path / "work"), "Unknown": 1}
    (tmp_path / "config.json").write_text(json.dumps(settings))
    config = MatchConfig.load(str(tmp_path / "config.json"))
    run = pipeline.match_files(spark, config)
    text = "".join(p.read_text() for p in (tmp_path / "result.txt").glob("part-*"))
    # The published expected result of this input.
    assert text.splitlines() == [
        "AGTTCAGCCA\tAGTTCAGCCA\t10\t0\tgene7\t20\t1\t>read3_matching",
        "CGGCTTACGG\tCGGCTTACGG\t0\t0\tgene5\t20\t1\t>read2_matching",
        "GTAGGATATC\tGTAGGATATC\t10\t0\tgene3\t20\t1\t>read1_matching",
    ]
    text = "".join(p.read_text() for p in (tmp_path / "result.nonmatch.txt.fastq").glob("part-*")).splitlines()
    assert text[0::4] == [">read6", ">read4", ">read5"] and set(text[3::4]) == {"!" * 10} and set(text[2::4]) == {"+"}
    assert {r["metric"] for r in run.metrics().collect()} >= {"skipped reads", "reads in window 0", "filter fill of window 1"}
    again = pipeline.match_files(spark, config, start=9)
    assert again.result().count() == 3
    with pytest.raises(ValueError, match="TempDir"):
        pipeline.Run(spark, MatchConfig(), None, None, start=3)


def test_a_later_start_wants_the_same_settings(spark, tmp_path):
    def run(start=0, targets=GENES, **settings):
        return a_run(spark, READS, targets, TempDir=str(tmp_path / "work"), start=start, **settings)

    first = run()
    assert first.result().count() == 3
    assert run(start=9).result().count() == 3
    assert run(start=9, BloomSize=77, MatchMode="any").result().count() == 3  # no table depends on these
    for start, settings, wrong in ((5, {"WindowWidth": 5}, "WindowWidth"), (6, {"PMatch": 0.9}, "PMatch"), (7, {"MMTol": 3}, "MMTol"), (2, {"Windows": (0, 6)}, "Windows"), (5, {"compat": True}, None), (6, {"compat": True}, "compat"), (6, {"MatchMode": "first"}, "MatchMode")):
        later = run(start=start, **settings)
        if wrong is None:
            assert later.result().count() == 3
            first = run()
            first.result()
        else:
            with pytest.raises(ValueError, match=f"another {wrong}"):
                later.result()
    assert run(start=5, PMatch=0.8).matches().count() >= 3  # what is before the change is read, the rest made anew
    with pytest.raises(ValueError, match="the table of named was made with another PMatch"):
        run(start=9, PMatch=0.8).result()
    (tmp_path / "work/matches.note").unlink()
    with pytest.raises(ValueError, match="no finished table of matches"):
        run(start=6, PMatch=0.8).best()


def test_figures_are_counted_in_passing(spark, monkeypatch):
    run = a_run(spark, [*READS, ("@short", "AC"), ("@twice", "GTAGGATATC")], GENES, MinReadLength=3)
    run.windows()
    monkeypatch.setattr(windows, "window_counts", None)
    monkeypatch.setattr(reads, "skipped_reads", None)
    got = {r["metric"]: r["value"] for r in run.metrics().collect()}
    keys = len({s[:4] for _, s in READS})
    assert (got["skipped reads"], got["reads in window 0"], got["reads in window 1"]) == (1, 6, 6)
    assert got["filter fill of window 0"] == pytest.approx(1 - 2.718281828459045 ** (-5 * keys / 1000))
    empty = a_run(spark, [], GENES)
    assert {r["value"] for r in empty.metrics().collect()} == {0}


def test_a_window_without_reads_stops_a_strict_run(spark, tmp_path):
    run = a_run(spark, READS, GENES, Windows=(0, 7), strict=True)
    with pytest.raises(ValueError, match="window 1, which ends after 11 letters"):
        run.result()
    assert a_run(spark, READS, GENES, Windows=(0, 7)).result().count() == 3


def test_sequences_that_occur_in_a_target(spark):
    rng = random.Random(12)
    genes = [(f"g{k}", "".join(rng.choice("ACGT") for _ in range(rng.choice([5, 60, 400])))) for k in range(30)] + [("poly", "A" * 300)]
    wanted = [g[a : a + n] for _, g in genes for a, n in ((0, 5), (3, 40), (50, 200)) if len(g) >= a + n]
    wanted += ["".join(rng.choice("ACGT") for _ in range(n)) for n in (5, 12, 60) for _ in range(20)] + [g[-30:] + "A" for _, g in genes if len(g) > 30] + ["A" * 300, "A" * 301, "", None]
    df = spark.createDataFrame([(w,) for w in wanted], "tseq string")
    targets = target_table(spark, genes)
    got = {r["tseq"] for r in results.contained(df, targets).collect()}
    assert got == {w for w in wanted if w is not None and any(w in g for _, g in genes)}
    assert {r["tseq"] for r in results.contained(df.filter("length(tseq) > 30"), targets).collect()} == {w for w in got if len(w) > 30}
    assert results.contained(df.filter("tseq is null"), targets).count() == results.contained(df, targets.limit(0)).count() == 0


MISMATCH_READ = "ACGTTGCAAGCTTACGATCG"
MISMATCH_TARGETS = [("t1", "AAAC" + MISMATCH_READ + "GGTT"), ("t2", "CC" + "ACGTTGCAAGCTTACGATCC" + "A"), ("t3", "ACGTTGCAAGGTTACGATCC")]


@pytest.mark.parametrize("tolerance, want", [(0, [("t1", 4, 0, 28)]), (1, [("t1", 4, 0, 28), ("t2", 2, 1, 23)]), (2, [("t1", 4, 0, 28), ("t2", 2, 1, 23), ("t3", 0, 2, 20)])])
def test_mismatches_and_tolerance(spark, tolerance, want):
    run = a_run(spark, [("@a", MISMATCH_READ)], MISMATCH_TARGETS, Windows=(0, 10), WindowWidth=8, PMatch=0.85, MinDinuc=3, MMTol=tolerance)
    assert sorted((r["name"], r["pos"], r["nmiss"], r["tlen"]) for r in run.result().collect()) == want


@pytest.mark.parametrize("seed", range(3))
def test_random_sequences_against_brute_force(spark, seed):
    rng = random.Random(seed)
    genes = [(f"g{k}", "".join(rng.choice("ACGTX") for _ in range(rng.choice([3, 30, 300, 700])))) for k in range(15)]
    found = []
    for k in range(40):
        _, t = rng.choice([g for g in genes if len(g[1]) >= 30])
        at, n = rng.randrange(len(t) - 20), rng.randint(12, 40)
        r = list(t[at : at + n])
        for _ in range(rng.randint(0, 3)):
            r[rng.randrange(len(r))] = rng.choice("ACGTN")
        found.append((f"@{k}", "".join(r)))
    run = a_run(spark, found, genes, Windows=(0, 6, 14), WindowWidth=6, PMatch=0.8, MinDinuc=3, MMTol=1, MaxMatches=10**6)
    got = sorted({(r["seq"], r["tseq"], r["pos"], r["nmiss"], r["name"], r["tlen"]) for r in run.result().collect()})
    assert got == sorted(set(brute(found, genes, (0, 6, 14), 6, 0.8, 1, 3))) and got
    matched = {r[0] for r in got}
    assert {r["seq"] for r in run.nonmatch().collect()} == {r["seq"] for r in run.reads().collect()} - matched
    assert results.matched_reads(run.result()).first()[0] == len(matched)
    assert results.unknown_reads(run.result(), run.reads()).count() == 0
    assert all(r["ok"] for r in results.verified_targets(run.best(), run.targets).collect())


def test_limits_of_a_window(spark):
    genes = [(f"g{k}", "A" * k + "ACGTACGG" + ("C" if k % 2 else "G")) for k in range(6)]
    first = a_run(spark, [("@r", "ACGTACGGG")], genes, Windows=(0,), WindowWidth=8, PMatch=0.8, MMTol=9, MaxMatches=2, MatchMode="first")
    assert first.matches().count() == 2
    best = a_run(spark, [("@r", "ACGTACGGG")], genes, Windows=(0,), WindowWidth=8, PMatch=0.8, MMTol=9, MaxMatches=2)
    assert [r["nmiss"] for r in best.matches().collect()] == [0, 0]
    compat = a_run(spark, [("@r", "ACGTACGGG")], genes, Windows=(0,), WindowWidth=8, PMatch=0.8, MMTol=9, MaxMatches=2, MatchMode="first")
    compat.compat = True
    assert compat.matches().count() == 3


def test_a_read_at_offset_0_longer_than_the_original_allows(spark):
    rng = random.Random(5)
    t = "".join(rng.choice("ACGT") for _ in range(130))
    run = a_run(spark, [("@r", t[:120])], [("g", t)], Windows=(0,), WindowWidth=10)
    assert run.result().count() == 1
    run = a_run(spark, [("@r", t[:120])], [("g", t)], Windows=(0,), WindowWidth=10)
    run.compat = True
    assert run.result().count() == 0


def test_same_match_through_two_windows_is_one(spark):
    run = a_run(spark, READS[:1], GENES)
    assert run.matches().count() == 2 and combine.distinct_matches(run.matches()).count() == 1


def test_no_match_and_empty_tables(spark):
    run = a_run(spark, [("@r", "ACACACACAC")], [("short", "AC")])
    assert run.result().count() == 0 and run.nonmatch().count() == 1
    empty = a_run(spark, [], GENES)
    assert empty.result().count() == 0 and empty.nonmatch().count() == 0


def test_reads_are_filtered_cut_and_joined(spark):
    rows = [("@b two", "ACGTA"), ("@a", "ACGTATTT"), ("@b two", "ACGTA"), ("@c", "AC"), ("@d", ""), ("@e", None), ("@n", "acgtN")]
    raw = spark.createDataFrame(rows, "name string, seq string")
    got = {r["seq"]: (r["n"], r["names"]) for r in reads.distinct_reads(reads.prepare_reads(raw, 3, 5)).collect()}
    assert got == {"ACGTA": (3, "@a;@b;@b"), "XXXXX": (1, "@n")}
    assert reads.skipped_reads(raw, 3).first()[0] == 2


def test_names_of_a_sequence_that_very_many_reads_share(spark):
    raw = spark.range(5000).select(F.concat(F.lit("@"), F.lpad(F.col("id").cast("string"), 6, "0")).alias("name"), F.lit("ACGT").alias("seq"))
    row = reads.distinct_reads(reads.prepare_reads(raw)).first()
    assert row["n"] == 5000 and row["names"] == ";".join(f"@{k:06d}" for k in range(5000))[:995] + "..."


def test_names_at_the_limit(spark):
    """Names without a token come first and show as separators alone: up to 1,000 letters stay whole."""
    rows, want = [(None, "GG")], {"GG": (1, "")}
    for k, (n, filled) in enumerate((n, filled) for n in (999, 1000, 1001, 1002, 1500) for filled in (0, 1, 2, 400, 2000)):
        seq = "ACGT" + "A" * k
        names = [""] * max(0, n - filled) + [f"@{i} x" for i in range(min(n, filled))]
        joined = ";".join(x.split(" ")[0] for x in sorted(names))
        want[seq] = (n + 1, joined if len(joined) <= 1000 else joined[:995] + "...")
        rows += [(x, seq) for x in [*names, None]]
    raw = spark.createDataFrame(rows, "name string, seq string").repartition(5)
    assert {r["seq"]: (r["n"], r["names"]) for r in reads.distinct_reads(raw).collect()} == want


def test_a_hot_read_sends_few_names(spark):
    """Each map task sends at most the limit's names of a sequence, in both rounds."""
    raw = spark.range(0, 10**6, numPartitions=16).select(F.concat(F.lit("@"), F.lpad(F.col("id").cast("string"), 7, "0")).alias("name"), F.when(F.col("id") < 10**6, "ACGT").otherwise("C").alias("seq"))
    df = reads.distinct_reads(raw)
    plan = df._jdf.queryExecution().executedPlan().toString()
    partial = [line for line in plan.splitlines() if "WindowGroupLimit" in line and "Partial" in line]
    assert len(partial) == 2 and all("1000, Partial" in line for line in partial)
    row = df.first()
    assert row["n"] == 10**6 and row["names"] == ";".join(f"@{k:07d}" for k in range(200))[:995] + "..."


def test_window_counts(spark):
    rows = spark.createDataFrame([("ACGTACGT",), ("ACGT",)], "seq string")
    assert [tuple(r) for r in windows.window_counts(rows, (0, 4, 9), 4).orderBy("k").collect()] == [(0, 2), (1, 1), (2, 0)]
    with pytest.raises(Exception, match="no read is long enough"):
        windows.window_counts(rows, (9,), 4, strict=True).collect()


def test_prepared_targets_in_framed_text(spark, tmp_path):
    from strandloom.sources import files

    (tmp_path / "genes.txt.sz").write_bytes(files.framed("".join(f"{s}\n" for _, s in GENES).encode()))
    (tmp_path / "genes_ids.txt.sz").write_bytes(files.framed("".join(f"{k:011d}\t{n}\t{len(s)}\n" for k, (n, s) in enumerate(GENES)).encode()))
    (tmp_path / "reads.fastq").write_text("".join(f"{n}\n{s}\n+\n{'!' * len(s)}\n" for n, s in READS))
    config = MatchConfig(str(tmp_path / "reads.fastq"), str(tmp_path / "genes.txt.sz"), str(tmp_path / "genes_ids.txt.sz"), str(tmp_path / "out"), (0, 5), 4, 1000, 5, 1.0, 1, str(tmp_path / "work"), 0, 300, 1000, 3, 1, "best")
    run = pipeline.match_files(spark, config)
    assert sorted((r["seq"], r["pos"], r["name"]) for r in run.result().collect()) == [("AGTTCAGCCA", 10, "gene7"), ("CGGCTTACGG", 0, "gene5"), ("GTAGGATATC", 10, "gene3")]
    assert spark.read.text(str(tmp_path / "work/log")).filter("value = 'All done, exiting'").count() == 1
    assert MatchConfig.from_json("\n".join(r[0] for r in spark.read.text(str(tmp_path / "work/config")).collect())) == config


def test_config():
    config = MatchConfig.from_json('{"readfilename": "a", "windows": [1, 2], "other": 3}', Windows="0,5", PMatch=0)
    assert config.ReadFileName == "a" and config.Windows == (0, 5)
    with pytest.raises(ValueError, match="GeneFileName"):
        config.checked()
    full = MatchConfig("a.fastq", "b", "c", "d", (0,), 5, 1, 1, 0.9, MaxReadLength=10, MaxMatches=1).checked()
    assert full.MatchMode == "first" and full.MaxMergeProcs == 3 and MatchConfig.from_json(full.to_json()) == full
