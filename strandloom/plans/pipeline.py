"""A whole run: reads and prepared targets to result and non-matching reads.

Stages have the numbers of the original's restart points; those that only sorted have no work here. A stage's table is
in the work folder, and a run can start at a later stage from the tables of an earlier one. Beside each table is a note
of the settings and inputs that it depends on, and of the figures that were counted while it was written: a run that
would read a table made with other settings, or one that was never finished, stops.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators import combine, matching, reads, results, scan, targets, windows
from ..sources import files, stores
from .config import MatchConfig
from .staging import forget_note, read_note, staged, work_dir, write_note

STAGES = ("reads", "windows", "sorted windows", "candidates", "sorted candidates", "matches", "best", "sorted best", "named", "result", "nonmatch")

#: The settings that come into play at each stage; a stage depends on those of all before it, too.
SETTINGS = {"reads": ("ReadFileName", "MinReadLength", "MaxReadLength"), "windows": ("Windows", "WindowWidth", "MinDinuc"), "candidates": ("GeneFileName",), "matches": ("PMatch", "MaxMatches", "MatchMode"), "best": ("MMTol",), "named": ("GeneIdFileName",)}


def prepare(spark: SparkSession, path: str, reverse: bool = False, framed_text: bool = False) -> tuple[str, str]:
    """Prepares a target file and returns where the two tables, or texts in the snappy framing format, are."""
    by_line = not files.is_fasta(path)
    return files.write_targets(targets.prepare_targets(files.read_targets(spark, path), reverse, by_line), path, framed_text)


class Run:
    """The stages of one run, each computed when it is asked for or read if the run starts after it.

    With ``strict`` a window that no read reaches the end of is an error. ``key_bytes`` of read windows are looked up as
    they are, more by a filter; keys of more pairs than ``hot`` says are merged in blocks of the size that it says.
    """

    def __init__(self, spark: SparkSession, config: MatchConfig, raw_reads: DataFrame, target_rows: DataFrame, start: int = 0, compat: bool = False, key_bytes: int = scan.KEY_BYTES, strict: bool = False, hot: tuple[int, int] = (matching.HOT_PAIRS, matching.BLOCK)) -> None:
        if not 0 <= start < len(STAGES):
            raise ValueError(f"stages are 0 to {len(STAGES) - 1}")
        if start and not config.TempDir:
            raise ValueError("to start at a later stage, TempDir must name the folder of an earlier run")
        self.spark, self.config, self.start, self.compat, self.key_bytes, self.strict, self.hot = spark, config, start, compat, key_bytes, strict, hot
        self.raw, self.targets, self.dir, self.done, self.notes = raw_reads, target_rows, work_dir(spark, config.TempDir), {}, {}

    def _depends(self, stage: str) -> dict:
        """The settings that a stage's table depends on, of files with the sizes of their parts, as JSON gives them back."""
        found = {}
        for name in STAGES[: STAGES.index(stage) + 1]:
            for setting in SETTINGS.get(name, ()):
                value = getattr(self.config, setting)
                if setting == "MatchMode":
                    value = "first" if value in ("", "first") else "best"
                if setting.endswith("FileName"):
                    value = [value, [list(f) for f in stores.files(value)] if value and stores.reachable(value) else []]
                found[setting] = list(value) if isinstance(value, tuple) else value
        if STAGES.index(stage) >= STAGES.index("matches"):
            found["compat"] = self.compat
        return found

    def _stage(self, name: str, make, seen: list[Observation] = ()) -> DataFrame:
        if name not in self.done:
            path, depends = f"{self.dir}/{name}", self._depends(name)
            if STAGES.index(name) < self.start:
                note = read_note(self.spark, f"{path}.note")
                if note is None:
                    raise ValueError(f"the run can't start at stage {self.start}: there is no finished table of {name} in {self.dir}")
                other = sorted(k for k in depends if note["depends"].get(k) != depends[k])
                if other:
                    raise ValueError(f"the run can't start at stage {self.start}: the table of {name} was made with another {', '.join(other)}")
                self.notes[name], self.done[name] = note["figures"], self.spark.read.parquet(path)
            else:
                rows = make()
                forget_note(self.spark, f"{path}.note")  # the table is about to be replaced
                table = staged(rows, path)
                self.notes[name] = {k: v for o in seen for k, v in o.get.items()}
                write_note(self.spark, f"{path}.note", {"depends": depends, "figures": self.notes[name]})
                self.done[name] = table
        return self.done[name]

    def reads(self) -> DataFrame:
        c, seen = self.config, Observation()

        def make() -> DataFrame:
            # read once: counts and names are taken from it apart
            return reads.distinct_reads(staged(reads.prepare_reads(self.raw, c.MinReadLength, c.MaxReadLength, seen), f"{self.dir}/prepared"))

        return self._stage("reads", make, [seen])

    def windows(self) -> DataFrame:
        c, seen = self.config, Observation()
        table = self._stage("windows", lambda: windows.read_windows(self.reads(), c.Windows, c.WindowWidth, c.MinDinuc, seen), [seen])
        missing = [k for k in range(len(c.Windows)) if not self.notes["windows"].get(f"reads {k}")]
        if self.strict and missing:
            raise ValueError(f"no read is long enough for window {missing[0]}, which ends after {c.Windows[missing[0]] + c.WindowWidth} letters")
        return table

    def candidates(self) -> DataFrame:
        """tnum, p, key, and of the target what the longest read covers: nothing has to be joined with targets later."""
        c = self.config
        before, after = max(c.Windows), max(0, c.MaxReadLength - c.WindowWidth - min(c.Windows))
        return self._stage("candidates", lambda: scan.candidates(self.targets, self.windows(), c.WindowWidth, before, after, c.BloomSize, c.NumHash, self.dir, self.key_bytes))

    def all_matches(self) -> DataFrame:
        """Verified matches before the limit on matches of a window."""
        return matching.verified(matching.window_pairs(self.candidates(), self.windows()), self.config.PMatch, self.config.WindowWidth, self.compat)

    def _hot_keys(self) -> DataFrame | None:
        """Most runs have none; where there are some, four joins use them."""
        hot = matching.hot_keys(self.candidates(), self.windows(), *self.hot)
        return None if hot.isEmpty() else staged(hot, f"{self.dir}/hot keys")

    def matches(self) -> DataFrame:
        c = self.config
        return self._stage("matches", lambda: matching.best_of_windows(self.candidates(), self.windows(), self._hot_keys(), c.PMatch, c.WindowWidth, c.MatchMode or "first", c.MaxMatches, c.MaxReadLength, self.compat).drop("tail"))

    def best(self) -> DataFrame:
        return self._stage("best", lambda: combine.best_per_read(combine.distinct_matches(self.matches()), self.config.MMTol))

    def named(self) -> DataFrame:
        return self._stage("named", lambda: results.with_target_names(self.best(), self.targets))

    def result(self) -> DataFrame:
        return self._stage("result", lambda: results.with_read_names(self.named(), self.reads()))

    def nonmatch(self) -> DataFrame:
        return self._stage("nonmatch", lambda: results.nonmatching(self.reads(), self.result()))

    def metrics(self) -> DataFrame:
        """metric, value: what the original's log says of a run, as it was counted while the stages were written."""
        self.reads(), self.windows()
        c, found = self.config, [("skipped reads", float(self.notes["reads"].get("skipped", 0)))]
        for k in range(len(c.Windows)):
            seen, keys = (self.notes["windows"].get(f"{what} {k}", 0) for what in ("reads", "keys"))
            found += [(f"reads in window {k}", float(seen)), (f"filter fill of window {k}", -math.expm1(-c.NumHash * keys / (c.BloomSize or 1)))]
        return self.spark.createDataFrame(found, "metric string, value double")


def match_files(spark: SparkSession, config: MatchConfig, start: int = 0, compat: bool = False) -> Run:
    """A run over files: results and non-matching reads are written where the configuration says, the settings as they
    were resolved and the run's figures to ``config`` and ``log`` in the work folder. A window without a read stops it."""
    config = config.checked()
    run = Run(spark, config, files.read_fastq(spark, config.ReadFileName), files.read_prepared(spark, config.GeneFileName, config.GeneIdFileName), start, compat, strict=True)
    spark.createDataFrame([(config.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{run.dir}/config")
    files.write_result(run.result(), config.ResultsFileName)
    files.write_nonmatch(run.nonmatch(), files.nonmatch_path(config.ResultsFileName))
    log = run.metrics().select(F.concat_ws(": ", "metric", F.col("value").cast("string")).alias("value"))
    log.union(spark.createDataFrame([("All done, exiting",)], "value string")).coalesce(1).write.mode("overwrite").text(f"{run.dir}/log")
    return run
