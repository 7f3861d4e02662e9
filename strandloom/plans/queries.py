"""Queries over the driver's tables, one for each operator, and the same in SQL.

Nothing there is biological, so text is put into the alphabet: letters become A, C, G and T in turn, all else X.
Targets are ``documents``; reads are stretches of ``benchmark``, whose passages occur in them, those of odd items with
one letter exchanged, some of them repeated, a few very often. Matching has variants of the targets beside them, with
letters exchanged or in short pieces, so that checks, limits and tolerances leave something out.
"""

from __future__ import annotations

from collections.abc import Callable
from string import ascii_letters

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import sequences as S
from ..operators import combine, reads, results, scan, targets, windows
from ..sources import files
from .config import MatchConfig
from .pipeline import STAGES, Run
from .staging import spread, staged, work_dir

_CYCLE = ("ACGT" * 13)[:52]
WIDTH, STARTS, SHARE, LEAST, MOST, DINUC, MATCHES, TOLERANCE = 20, (0, 15, 30, 45), 0.9, 60, 100, 6, 3, 0
CONFIG = MatchConfig(Windows=STARTS, WindowWidth=WIDTH, PMatch=SHARE, MinReadLength=LEAST, MaxReadLength=MOST, MinDinuc=DINUC, MaxMatches=MATCHES, MMTol=TOLERANCE, MatchMode="best", BloomSize=4_000_000, NumHash=20)
#: What the number of a target's variant is higher by.
VARIANT = 1_000_000_000_000
#: Letters of a target's pieces.
PIECE = 250


def encoded(text: Column) -> Column:
    return S.normalised(F.translate(text, ascii_letters, _CYCLE))


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def target_rows(spark: SparkSession, sf_dir: str, reverse: bool = False) -> DataFrame:
    rows = spread(_table(spark, sf_dir, "documents").filter("text is not null").select("doc_id", "text"))
    rows = rows.select(F.col("doc_id").alias("number"), F.concat(F.lit("doc"), F.col("doc_id").cast("string")).alias("name"), F.translate("text", ascii_letters, _CYCLE).alias("seq"))
    return targets.prepare_targets(rows, reverse)  # what is no letter becomes X there


def match_targets(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The targets, of every third one a variant with a letter exchanged here and there, of every other third one with
    short stretches lost, so that reads differ in more places than allowed, and the last third in short pieces, past
    whose ends reads run."""
    rows = target_rows(spark, sf_dir)
    third = lambda k: rows.filter((F.col("tnum") % 3 == k) & (F.col("tlen") > 0))
    few = third(0).select((F.col("tnum") + VARIANT).alias("tnum"), F.concat("name", F.lit("v")).alias("name"), F.replace("seq", F.lit("GCT"), F.lit("GAT")).alias("seq"))
    many = third(1).select((F.col("tnum") + VARIANT).alias("tnum"), F.concat("name", F.lit("w")).alias("name"), F.regexp_replace("seq", "(.{40}).{12}", "$1XXXXXXXXXXXX").alias("seq"))
    cut = third(2).select("tnum", "name", "seq", F.explode(F.sequence(F.lit(0), F.col("tlen") - 1, F.lit(PIECE))).alias("at"))
    cut = cut.select((-1 - F.col("tnum") * 1_000_000 - F.col("at") / PIECE).cast("bigint").alias("tnum"), F.concat("name", F.lit("p"), F.col("at").cast("string")).alias("name"), F.substr("seq", F.col("at") + 1, F.lit(PIECE)).alias("seq"))
    other = few.unionByName(many).unionByName(cut).select("tnum", F.col("tnum").alias("id_num"), "name", "seq", F.length("seq").alias("tlen"))
    return rows.unionByName(other)


def raw_reads(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _table(spark, sf_dir, "benchmark").filter("length(text) > 0")
    rows = rows.select("item_id", encoded(F.col("text")).alias("text"), F.explode(F.sequence(F.lit(0), F.length("text") - 1, F.lit(50))).alias("o"))
    times = F.when((F.col("item_id") % 20 == 0) & (F.col("o") == 0), 200).when(F.col("item_id") % 3 == 0, 2).otherwise(1)
    rows = rows.withColumn("seq", F.substr("text", F.col("o") + 1, F.lit(120))).withColumn("i", F.explode(F.sequence(F.lit(1), times)))
    at = (F.col("item_id") % 40).cast("int")
    changed = F.concat(F.substr("seq", F.lit(1), at), F.translate(F.substr("seq", at + 1, F.lit(1)), "ACGT", "TGCA"), F.substr("seq", at + 2, F.lit(1000)))
    name = F.concat(F.lit("@r"), F.col("item_id").cast("string"), F.lit("_"), F.col("o").cast("string"), F.lit("_"), F.col("i").cast("string"), F.lit(" tile"))
    return rows.select(name.alias("name"), F.when(F.col("item_id") % 2 == 1, changed).otherwise(F.col("seq")).alias("seq"))


def a_run(spark: SparkSession, sf_dir: str, options: dict | None = None, **other) -> Run:
    run = Run(spark, CONFIG.overridden(**other), raw_reads(spark, sf_dir), None, **(options or {}))
    # encoded once: else each window of a target would encode it anew
    run.targets = staged(match_targets(spark, sf_dir), f"{run.dir}/targets")
    return run


def _found(spark: SparkSession, sf_dir: str, mode: str, **options) -> DataFrame:
    return a_run(spark, sf_dir, options, MatchMode=mode, MaxMatches=1).matches().select("k", "q", "key", "seq", "tseq", "pos", "nmiss", "tnum")


def subx(spark, sf_dir):
    return _table(spark, sf_dir, "documents").select("doc_id", S.normalised(F.col("text")).alias("seq"))


def revcomp(spark, sf_dir):
    return target_rows(spark, sf_dir).select("tnum", S.reverse_complement(F.col("seq")).alias("seq"))


def dinuc(spark, sf_dir):
    return target_rows(spark, sf_dir).select("tnum", S.dinucleotides(F.col("seq")).alias("n"))


def hamming(spark, sf_dir):
    """Each text against the next one, the shorter padded with X to the length of the longer."""
    # encoded once for both sides
    one = staged(target_rows(spark, sf_dir).select("tnum", F.col("seq").alias("a")), f"{work_dir(spark)}/encoded")
    two = one.select((F.col("tnum") - 1).alias("tnum"), F.col("a").alias("b"))
    return S.differing(one.join(two, "tnum"), "tnum", "a", "b")


def allowed(spark, sf_dir):
    return target_rows(spark, sf_dir).select("tnum", S.allowed_mismatches(F.col("tlen"), SHARE).alias("allowed"))


def shortened_names(spark, sf_dir):
    text = F.col("text")
    return _table(spark, sf_dir, "documents").select("doc_id", S.shortened(text).alias("name"), S.first_token(text).alias("first"))


def prep_targets(spark, sf_dir):
    return target_rows(spark, sf_dir).select(S.padded_number(F.col("id_num")).alias("id_num"), "name", "seq", "tlen")


def prep_targets_rev(spark, sf_dir):
    return target_rows(spark, sf_dir, True).select(S.padded_number(F.col("id_num")).alias("id_num"), "name", "seq", "tlen")


def prep_reads(spark, sf_dir):
    return reads.prepare_reads(raw_reads(spark, sf_dir), LEAST, MOST)


def skipped_reads(spark, sf_dir):
    return reads.skipped_reads(raw_reads(spark, sf_dir), LEAST)


def read_dedup(spark, sf_dir):
    return reads.distinct_reads(prep_reads(spark, sf_dir))


def read_windows(spark, sf_dir):
    return windows.window_sides(windows.read_windows(read_dedup(spark, sf_dir), STARTS, WIDTH, DINUC), WIDTH)


def window_counts(spark, sf_dir):
    return windows.window_counts(read_dedup(spark, sf_dir), STARTS, WIDTH)


def bloom_fill(spark, sf_dir):
    rows = windows.fill_estimate(windows.read_windows(read_dedup(spark, sf_dir), STARTS, WIDTH, DINUC), CONFIG.BloomSize, CONFIG.NumHash)
    return rows.select("k", "n_keys", F.round("fill", 9).alias("fill"))


def measured_fill(spark, sf_dir):
    """How full the windows' filters are by their bits, and whether the formula of ``bloom_fill`` says so within 1 %."""
    found = windows.read_windows(read_dedup(spark, sf_dir), STARTS, WIDTH, DINUC)
    rows = scan.measured_fill(found, WIDTH, CONFIG.BloomSize, CONFIG.NumHash)
    wanted = 1 - F.exp(-F.lit(float(CONFIG.NumHash)) * F.col("n_keys") / F.lit(float(CONFIG.BloomSize)))
    return rows.select("k", "n_keys", (F.abs(F.col("fill") - wanted) <= 0.01 * wanted).alias("as_estimated"))


def kmer_candidates(spark, sf_dir):
    return a_run(spark, sf_dir).candidates().select("tnum", "p", "key")


def filtered_candidates(spark, sf_dir):
    """The same through the filter that takes the place of a table of too many read windows."""
    return a_run(spark, sf_dir, {"key_bytes": 0}).candidates().select("tnum", "p", "key")


def verified_matches(spark, sf_dir):
    return a_run(spark, sf_dir).all_matches().select("k", "q", "key", "seq", "tnum", "pos", "tseq", "nmiss")


def topk_first(spark, sf_dir):
    return _found(spark, sf_dir, "first")


def topk_best(spark, sf_dir):
    return _found(spark, sf_dir, "best")


def merged_first(spark, sf_dir):
    """The same with every key of more than one pair merged in scan order, in small blocks, as very common keys are."""
    return _found(spark, sf_dir, "first", hot=(1, 4))


def merged_best(spark, sf_dir):
    return _found(spark, sf_dir, "best", hot=(1, 4))


def compat_first(spark, sf_dir):
    """With the original's extra match, its scan order of long right sides, and its limit at target offset 0."""
    return _found(spark, sf_dir, "first", compat=True)


def distinct_matches(spark, sf_dir):
    return combine.distinct_matches(a_run(spark, sf_dir).all_matches())


def best_per_read(spark, sf_dir):
    return a_run(spark, sf_dir).best()


def target_names(spark, sf_dir):
    return a_run(spark, sf_dir).named()


def result(spark, sf_dir):
    return a_run(spark, sf_dir).result()


def nonmatch(spark, sf_dir):
    return a_run(spark, sf_dir).nonmatch()


def matched_reads_count(spark, sf_dir):
    return results.matched_reads(result(spark, sf_dir))


def matched_targets_count(spark, sf_dir):
    return results.matched_targets(result(spark, sf_dir))


def except_names(spark, sf_dir):
    run = a_run(spark, sf_dir)
    return results.unmatched_names(run.reads(), run.result())


def verify_reads(spark, sf_dir):
    run = a_run(spark, sf_dir)
    good, bad = results.verified_reads(run.result(), run.reads()), results.unknown_reads(run.result(), run.reads())
    return good.agg(F.count("*").alias("n")).select(F.lit("known").alias("reads"), "n").union(bad.agg(F.count("*")).select(F.lit("unknown"), "count(1)"))


def verify_targets(spark, sf_dir):
    run = a_run(spark, sf_dir)
    return results.verified_targets(run.best(), run.targets)


def contained_targets(spark, sf_dir):
    """Which stretches of matched targets, and which reads, occur in a target, without a look at its number or place."""
    run = a_run(spark, sf_dir)
    wanted = run.best().select("tseq").union(run.reads().select("seq")).distinct()
    return wanted.join(results.contained(wanted, run.targets, work=run.dir).withColumn("found", F.lit(True)), "tseq", "left").select("tseq", F.coalesce("found", F.lit(False)).alias("found"))


def run_metrics(spark, sf_dir):
    """What a run's log says of its reads."""
    return a_run(spark, sf_dir).metrics().filter("metric not like 'filter%'").select("metric", F.col("value").cast("bigint").alias("value"))


def fastq_scan(spark, sf_dir):
    """The reads, written as a FASTQ file and read again."""
    path = f"{work_dir(spark)}/reads.fastq"
    raw_reads(spark, sf_dir).select(F.concat_ws("\n", "name", "seq", F.lit("+"), F.repeat(F.lit("!"), F.length("seq"))).alias("value")).write.text(path)
    return files.read_fastq(spark, path)


def _target_file(spark, sf_dir, end: str, line: Column) -> DataFrame:
    """The texts, written as parts of a target file in the order of their ids, read again and prepared."""
    path = f"{work_dir(spark)}/genes.{end}"
    rows = target_rows(spark, sf_dir).filter("tlen > 0").orderBy("tnum")
    rows.select(line.alias("value")).write.text(path)
    return targets.prepare_targets(files.read_targets(spark, path), reverse=True, by_line=not files.is_fasta(path)).select(S.padded_number(F.col("id_num")).alias("id_num"), "tnum", "name", "seq", "tlen")


def fasta_scan(spark, sf_dir):
    lines = F.concat_ws("\n", F.concat(F.lit(">"), "name"), F.substring("seq", 1, 60), F.substr("seq", F.lit(61), F.greatest(F.length("seq") - 60, F.lit(0))))
    return _target_file(spark, sf_dir, "fasta", lines)


def text_scan(spark, sf_dir):
    return _target_file(spark, sf_dir, "txt", F.concat_ws("\t", "name", "seq"))


def framed_scan(spark, sf_dir):
    """The prepared targets with their reverse strands, written as two framed texts and read again by place."""
    rows = targets.prepare_targets(target_rows(spark, sf_dir).filter("tlen > 0").select(F.col("tnum").alias("number"), "name", "seq"), reverse=True)
    sequences, ids = files.write_targets(rows, f"{work_dir(spark)}/genes.txt", framed_text=True)
    return files.read_prepared(spark, sequences, ids)


def result_lines(spark, sf_dir):
    """The lines of a written result."""
    path = f"{work_dir(spark)}/result.txt"
    files.write_result(result(spark, sf_dir), path)
    return spark.read.text(path).select(F.col("value").alias("line"))


def result_order(spark, sf_dir):
    """The lines of a written result with their numbers over its parts."""
    path = f"{work_dir(spark)}/result.txt"
    files.write_result(result(spark, sf_dir), path)
    return files.lines(spark, path, across=True).select("number", F.col("value").alias("line"))


def restarted_result(spark, sf_dir):
    """The result of a run that starts at a later stage, from the tables of an earlier run."""
    run = a_run(spark, sf_dir, TempDir=work_dir(spark))
    run.matches()
    later = Run(spark, run.config, run.raw, run.targets, start=STAGES.index("matches") + 1)
    return later.result()


def nonmatch_lines(spark, sf_dir):
    """The records of a written file of reads without a match."""
    path = f"{work_dir(spark)}/result.nonmatch.txt.fastq"
    files.write_nonmatch(nonmatch(spark, sf_dir), path)
    return files.read_fastq(spark, path)


_NAMES = (
    "fastq_scan", "fasta_scan", "text_scan", "framed_scan", "result_lines", "result_order", "restarted_result", "nonmatch_lines", "subx", "revcomp", "dinuc", "hamming", "allowed", "shortened_names", "prep_targets", "prep_targets_rev", "prep_reads", "skipped_reads", "read_dedup", "read_windows", "window_counts", "bloom_fill", "measured_fill", "kmer_candidates", "filtered_candidates",
    "verified_matches", "topk_first", "topk_best", "merged_first", "merged_best", "compat_first", "distinct_matches", "best_per_read", "target_names", "result", "nonmatch", "matched_reads_count", "matched_targets_count", "except_names", "verify_reads", "verify_targets", "contained_targets", "run_metrics",
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {k: globals()[k] for k in _NAMES}


def _encoded(text: str) -> str:
    return f"regexp_replace(translate({text}, '{ascii_letters}', '{_CYCLE}'), '[^ACGT]', 'X', 'g')"


def _short(text: str) -> str:
    return f"CASE WHEN length({text}) > 1000 THEN substr({text}, 1, 995) || '...' ELSE {text} END"


def _varied(seq: str) -> str:
    return f"len(list_distinct([substr({seq}, i, 2) for i in range(1, greatest(length({seq}), 1))]))"


_TARGETS = f"t AS (SELECT doc_id AS tnum, 'doc' || doc_id AS name, {_encoded('text')} AS seq, length(text)::INT AS tlen FROM documents WHERE text IS NOT NULL)"
_MATCH_TARGETS = f"""{_TARGETS.replace('t AS', 'plain AS', 1)},
t AS (SELECT * FROM plain UNION ALL SELECT tnum + {VARIANT}, name || 'v', replace(seq, 'GCT', 'GAT'), tlen FROM plain WHERE tnum % 3 = 0
 UNION ALL SELECT tnum + {VARIANT}, name || 'w', regexp_replace(seq, '(.{{40}}).{{12}}', '\\1XXXXXXXXXXXX', 'g'), tlen FROM plain WHERE tnum % 3 = 1
 UNION ALL SELECT -1 - tnum * 1000000 - a // {PIECE}, name || 'p' || a, substr(seq, a + 1, {PIECE}), length(substr(seq, a + 1, {PIECE}))::INT FROM (SELECT *, unnest(range(0, tlen, {PIECE})) AS a FROM plain WHERE tnum % 3 = 2))"""
_RAW = f"""b AS (SELECT item_id, unnest(range(0, length(text), 50)) AS o, {_encoded('text')} AS text FROM benchmark WHERE length(text) > 0),
copies AS (SELECT item_id, o, text, unnest(range(1, CASE WHEN item_id % 20 = 0 AND o = 0 THEN 201 WHEN item_id % 3 = 0 THEN 3 ELSE 2 END)) AS i FROM b),
c AS (SELECT item_id, (item_id % 40)::INT AS place, '@r' || item_id || '_' || o || '_' || i || ' tile' AS name, substr(text, o + 1, 120) AS seq FROM copies),
raw AS (SELECT name, CASE WHEN item_id % 2 = 1 THEN substr(seq, 1, place) || translate(substr(seq, place + 1, 1), 'ACGT', 'TGCA') || substr(seq, place + 2) ELSE seq END AS seq FROM c)"""
_PREPARED = f"{_RAW},\nprepared AS (SELECT substr(seq, 1, {MOST}) AS seq, name FROM raw WHERE length(seq) >= {LEAST})"
_READS = f"""{_PREPARED},
joined AS (SELECT seq, count(*) AS n, string_agg(regexp_extract(name, '^\\s*(\\S+)', 1), ';' ORDER BY name) AS names FROM prepared GROUP BY seq),
reads AS (SELECT seq, n, {_short('names')} AS names FROM joined)"""
_WINDOWS = f"""{_READS},
starts AS (SELECT * FROM (VALUES {', '.join(f'({k}, {q})' for k, q in enumerate(STARTS))}) AS s(k, q)),
win AS (SELECT k, q, substr(seq, q + 1, {WIDTH}) AS key, seq FROM reads, starts WHERE length(seq) >= q + {WIDTH} AND {_varied(f'substr(seq, q + 1, {WIDTH})')} >= {DINUC})"""
_CANDIDATES = f"""{_MATCH_TARGETS},
{_WINDOWS},
tiles AS (SELECT tnum, s, substr(seq, s + 1, {256 + WIDTH - 1}) AS tile FROM (SELECT tnum, seq, unnest(range(0, tlen - {WIDTH} + 1, 256)) AS s FROM t WHERE tlen >= {WIDTH})),
kmers AS (SELECT tnum, s + i AS p, substr(tile, i + 1, {WIDTH}) AS key FROM (SELECT tnum, s, tile, unnest(range(0, length(tile) - {WIDTH} + 1)) AS i FROM tiles)),
cand AS (SELECT tnum, p, key FROM kmers WHERE key IN (SELECT key FROM win))"""
_ALL = f"""{_CANDIDATES},
pairs AS (SELECT k, q, key, win.seq, t.tnum, p, (p - q)::INT AS pos, substr(t.seq, p - q + 1, length(win.seq)) AS tseq, substr(t.seq, p + {WIDTH} + 1, greatest({MOST - WIDTH} - q, 0)) AS tail FROM cand JOIN win USING (key) JOIN t ON t.tnum = cand.tnum WHERE p >= q AND p - q + length(win.seq) <= tlen),
every AS (SELECT *, hamming(seq, tseq)::INT AS nmiss FROM pairs WHERE hamming(seq, tseq) <= trunc((1.0::DOUBLE - {SHARE}::DOUBLE) * length(seq)))"""


def _limited(mode: str, most: int, right: str = f"substr(tseq, q + {WIDTH} + 1)", only: str = "true") -> str:
    order = f"substr(tseq, 1, q), {right}, tnum, p::VARCHAR, substr(seq, 1, q), substr(seq, q + {WIDTH} + 1)"
    order = order if mode == "first" else f"nmiss, {order}"
    return f"{_ALL},\nmatches AS (SELECT * FROM every WHERE {only} QUALIFY row_number() OVER (PARTITION BY k, key ORDER BY {order}) <= {most})"


_BEST = f"""{_limited('best', MATCHES)},
once AS (SELECT DISTINCT seq, tseq, pos, nmiss, tnum FROM matches),
best AS (SELECT seq, tseq, pos, nmiss, tnum FROM once QUALIFY nmiss <= min(nmiss) OVER (PARTITION BY seq) + {TOLERANCE}),
named AS (SELECT best.seq, tseq, pos, nmiss, name, tlen FROM best JOIN t USING (tnum)),
result AS (SELECT named.*, n, names FROM named JOIN reads USING (seq))"""


def oracle_sql() -> dict[str, str]:
    matched = "SELECT k, q, key, seq, tseq, pos, nmiss, tnum FROM matches"
    both = "SELECT {0} AS id_num, 2 * {1} AS tnum, {2} || name AS name, seq, tlen FROM f UNION ALL SELECT {3}, 2 * {1} + 1, {2} || name || '_r', translate(reverse(seq), 'ACGT', 'TGCA'), tlen FROM f"
    filed = f"WITH {_TARGETS}, f AS (SELECT row_number() OVER (ORDER BY tnum) - 1 AS number, name, seq, tlen FROM t WHERE tlen > 0)"
    padded = "lpad(({0})::VARCHAR, 11, '0')".format
    return {
        "fastq_scan": f"WITH {_RAW} SELECT name, seq FROM raw",
        "fasta_scan": f"{filed} {both.format(padded('2 * number'), 'number', chr(39) + '>' + chr(39), padded('2 * number + 1'))}",
        "text_scan": f"{filed} {both.format(padded('number'), 'number', chr(39) * 2, padded('number'))}",
        "framed_scan": f"{filed}, b AS (SELECT tnum, 0 AS r, name, seq, tlen FROM (SELECT number AS tnum, name, seq, tlen FROM f) UNION ALL SELECT number, 1, name || '_r', translate(reverse(seq), 'ACGT', 'TGCA'), tlen FROM f) SELECT row_number() OVER (ORDER BY tnum, r) - 1 AS tnum, name, seq, tlen FROM b",
        "result_lines": f"WITH {_BEST} SELECT concat_ws(chr(9), seq, tseq, pos, nmiss, name, tlen, n, names) AS line FROM result",
        "result_order": f"WITH {_BEST}, texts AS (SELECT seq, tseq, pos::VARCHAR AS pos, nmiss::VARCHAR AS nmiss, name, tlen::VARCHAR AS tlen, n::VARCHAR AS n, names FROM result) SELECT row_number() OVER (ORDER BY seq, tseq, pos, nmiss, name, tlen, n, names) - 1 AS number, concat_ws(chr(9), seq, tseq, pos, nmiss, name, tlen, n, names) AS line FROM texts",
        "restarted_result": f"WITH {_BEST} SELECT * FROM result",
        "nonmatch_lines": f"WITH {_BEST} SELECT names AS name, seq FROM reads WHERE seq NOT IN (SELECT seq FROM result)",
        "subx": "SELECT doc_id, regexp_replace(text, '[^ACGT]', 'X', 'g') AS seq FROM documents",
        "revcomp": f"WITH {_TARGETS} SELECT tnum, translate(reverse(seq), 'ACGT', 'TGCA') AS seq FROM t",
        "dinuc": f"WITH {_TARGETS} SELECT tnum, {_varied('seq')}::INT AS n FROM t",
        "hamming": f"WITH {_TARGETS}, a AS (SELECT x.tnum, x.seq AS a, y.seq AS b, greatest(length(x.seq), length(y.seq))::INT AS n FROM t x JOIN t y ON y.tnum = x.tnum + 1) SELECT tnum, hamming(rpad(a, n, 'X'), rpad(b, n, 'X'))::INT AS nmiss FROM a",
        "allowed": f"WITH {_TARGETS} SELECT tnum, trunc((1.0::DOUBLE - {SHARE}::DOUBLE) * tlen)::INT AS allowed FROM t",
        "shortened_names": f"SELECT doc_id, {_short('text')} AS name, regexp_extract(text, '^\\s*(\\S+)', 1) AS first FROM documents",
        "prep_targets": f"WITH {_TARGETS} SELECT lpad(tnum::VARCHAR, 11, '0') AS id_num, name, seq, tlen FROM t",
        "prep_targets_rev": f"WITH {_TARGETS} SELECT lpad((2 * tnum)::VARCHAR, 11, '0') AS id_num, name, seq, tlen FROM t UNION ALL SELECT lpad((2 * tnum + 1)::VARCHAR, 11, '0'), name || '_r', translate(reverse(seq), 'ACGT', 'TGCA'), tlen FROM t",
        "prep_reads": f"WITH {_PREPARED} SELECT seq, name FROM prepared",
        "skipped_reads": f"WITH {_RAW} SELECT count(*) FILTER (length(seq) < {LEAST}) AS skipped FROM raw",
        "read_dedup": f"WITH {_READS} SELECT seq, n, names FROM reads",
        "read_windows": f'WITH {_WINDOWS} SELECT k, q, key, substr(seq, 1, q) AS "left", substr(seq, q + {WIDTH} + 1) AS "right", seq FROM win',
        "window_counts": f"WITH {_WINDOWS} SELECT k, count(*) FILTER (length(seq) >= q + {WIDTH}) AS n_reads FROM reads, starts GROUP BY k",
        "bloom_fill": f"WITH {_WINDOWS} SELECT k, count(DISTINCT key) AS n_keys, round(1 - exp(-{CONFIG.NumHash}.0 * count(DISTINCT key) / {CONFIG.BloomSize}.0), 9) AS fill FROM win GROUP BY k",
        "measured_fill": f"WITH {_WINDOWS} SELECT k, count(DISTINCT key) AS n_keys, true AS as_estimated FROM win GROUP BY k",
        "kmer_candidates": f"WITH {_CANDIDATES} SELECT tnum, p, key FROM cand",
        "filtered_candidates": f"WITH {_CANDIDATES} SELECT tnum, p, key FROM cand",
        "verified_matches": f"WITH {_ALL} SELECT k, q, key, seq, tnum, pos, tseq, nmiss FROM every",
        "topk_first": f"WITH {_limited('first', 1)} {matched}",
        "topk_best": f"WITH {_limited('best', 1)} {matched}",
        "merged_first": f"WITH {_limited('first', 1)} {matched}",
        "merged_best": f"WITH {_limited('best', 1)} {matched}",
        "compat_first": f"WITH {_limited('first', 2, 'tail', 'q > 0 OR p > 0 OR length(seq) <= 100')} {matched}",
        "distinct_matches": f"WITH {_ALL} SELECT DISTINCT seq, tseq, pos, nmiss, tnum FROM every",
        "best_per_read": f"WITH {_BEST} SELECT * FROM best",
        "target_names": f"WITH {_BEST} SELECT * FROM named",
        "result": f"WITH {_BEST} SELECT * FROM result",
        "nonmatch": f"WITH {_BEST} SELECT names, seq, repeat('!', length(seq)) AS qual FROM reads WHERE seq NOT IN (SELECT seq FROM result)",
        "matched_reads_count": f"WITH {_BEST} SELECT count(DISTINCT seq) AS n_reads FROM result",
        "matched_targets_count": f"WITH {_BEST} SELECT count(DISTINCT name) AS n_targets FROM result",
        "except_names": f"WITH {_BEST} SELECT names FROM reads EXCEPT SELECT names FROM result",
        "verify_reads": f"WITH {_BEST} SELECT 'known' AS reads, count(*) AS n FROM result WHERE seq IN (SELECT seq FROM reads) UNION ALL SELECT 'unknown', count(*) FROM result WHERE seq NOT IN (SELECT seq FROM reads)",
        "contained_targets": f"WITH {_BEST}, wanted AS (SELECT tseq FROM best UNION SELECT seq FROM reads) SELECT tseq, EXISTS (SELECT 1 FROM t WHERE contains(t.seq, tseq)) AS found FROM wanted",
        "run_metrics": f"WITH {_WINDOWS} SELECT 'skipped reads' AS metric, count(*) FILTER (length(seq) < {LEAST}) AS value FROM raw UNION ALL SELECT 'reads in window ' || k, count(*) FILTER (length(seq) >= q + {WIDTH}) FROM reads, starts GROUP BY k",
        "verify_targets": f"WITH {_BEST} SELECT best.*, substr(t.seq, pos + 1, length(tseq)) = tseq AS ok FROM best JOIN t USING (tnum)",
    }
