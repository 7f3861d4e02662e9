"""Secret scan with multipart credential linking, in DataFrame functions only.

Strong spans come from three patterns: assignments of a secret, access identifiers, long hexadecimal runs. Beyond
them there are weak parts: unlabelled keys, short assigned values, user or client identifiers, endpoints. A weak part
is reported only when complementary parts stand within ``scope`` code points of it, which an interval join over bins
of that width finds:

* ``link_secret``: a weak secret with an access identifier (strong or weak) in its scope;
* ``link_access``: a weak identifier with a secret and an endpoint in its scope;
* ``link_endpoint``: an endpoint with an access identifier and a secret in its scope.

Only rows that hold weak parts and a complement are exploded and joined; a bin holds no more parts than its width has
room for, so the join stays linear in the text.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import pick, place, stored

# The strong patterns. Their length limits hold for whole matches, or for the assigned value.
ASSIGN = r"""((?i:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{12,}"  # as AKIA[A-Z0-9]+ of 16 or more: a shorter run has no later match of that length
HEX = r"[0-9a-f]{32,}"  # as runs [0-9a-f]+ of 32 or more
# Weak parts.
KEY = r"(?<![A-Za-z0-9+/=_-])(?=[A-Za-z0-9+/]{0,39}[0-9])(?=[A-Za-z0-9+/]{0,39}[A-Z])(?=[A-Za-z0-9+/]{0,39}[a-z])[A-Za-z0-9+/]{40}(?![A-Za-z0-9+/=_-])"
IDENTIFIER = r"""(?i:access_?key(?:_?id)?|client_?id|user_?name|user|login)["']?\x20*[:=]\x20*["']?[A-Za-z0-9._@-]{3,}"""
ENDPOINT = r"""(?i:https?|postgres|postgresql|mysql|mongodb|redis|amqp|s3)://[^\s"'<>]+|(?i:host|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]{4,}"""
KINDS = ("assign", "access", "hex", "link_secret", "link_access", "link_endpoint")
SPAN = "array<struct<start:bigint,kind:int,stop:bigint>>"
#: Elements of a block of running sums, code points of a piece of a text.
BLOCK, PIECE = 256, 4096


def running(numbers: Column, merge: Callable[[Column, Column], Column]) -> Column:
    """An array of what ``merge`` makes of all elements (of 0 and more) up to each place: within blocks of ``BLOCK``, with
    what the blocks before come to carried along once a block."""
    total = lambda a: F.aggregate(a, F.lit(0).cast("bigint"), merge)
    first = F.sequence(F.lit(0), F.greatest(F.size(numbers) - 1, F.lit(0)), F.lit(BLOCK))
    blocks = F.transform(first, lambda b: F.slice(numbers, b + 1, F.lit(BLOCK)))
    # one array, so that each block's total is taken once
    before = F.transform(F.array(F.transform(blocks, total)), lambda sums: F.transform(sums, lambda _, b: total(F.slice(sums, F.lit(1), b))))[0]
    within = F.zip_with(blocks, before, lambda block, carried: F.transform(block, lambda _, i: merge(carried, total(F.slice(block, F.lit(1), i + 1)))))
    return F.when(F.size(numbers) == 0, F.array().cast("array<bigint>")).otherwise(F.flatten(within))


def running_sums(numbers: Column) -> Column:
    """Sums of an array's elements up to each place."""
    return running(numbers, lambda x, y: x + y)


def matches(text: Column, pattern: str, kind: int) -> Column:
    """Leftmost matches that do not overlap, as structs of start, kind, stop (code points) and the matched text."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    between = F.slice(F.split(text, pattern, -1), F.lit(1), F.size(found))
    ends = running_sums(F.zip_with(between, found, lambda a, b: (F.length(a) + F.length(b)).cast("bigint")))
    spans = F.zip_with(found, ends, lambda m, e: F.struct((e - F.length(m)).alias("start"), F.lit(kind).alias("kind"), e.alias("stop"), m.alias("found")))
    return F.when(text.rlike(pattern), spans).otherwise(F.array().cast("array<struct<start:bigint,kind:int,stop:bigint,found:string>>"))


def _bare(spans: Column) -> Column:
    return F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["kind"].alias("kind"), s["stop"].alias("stop")))


def told(spans: Column, names: tuple[str, ...] = KINDS) -> Column:
    """kind:start:end of sorted spans, comma-joined."""
    kind = F.array(*map(F.lit, names))
    return F.array_join(F.transform(F.array_sort(spans), lambda s: F.concat_ws(":", F.element_at(kind, s["kind"] + 1), s["start"].cast("string"), s["stop"].cast("string"))), ",")


def _near(parts: DataFrame, other: DataFrame, scope: int) -> DataFrame:
    """The parts that have one of ``other`` within ``scope`` code points, in the same text: an interval semi-join.

    A part goes to the bins that its widened interval touches, the other side to the bins that it fills itself.
    """
    low, high = F.greatest(F.col("start") - scope, F.lit(0)), F.col("stop") + scope
    mine = parts.withColumn("bin", F.explode(F.sequence(F.floor(low / scope), F.floor(high / scope))))
    theirs = other.withColumn("bin", F.explode(F.sequence(F.floor(F.col("start") / scope), F.floor(F.col("stop") / scope))))
    theirs = theirs.select("key", "bin", F.col("start").alias("o_start"), F.col("stop").alias("o_stop"))
    close = (F.col("o_start") <= F.col("stop") + scope) & (F.col("o_stop") >= F.col("start") - scope)
    apart = (F.col("o_stop") <= F.col("start")) | (F.col("o_start") >= F.col("stop"))
    return mine.join(theirs.withColumnRenamed("key", "o_key").withColumnRenamed("bin", "o_bin"), (F.col("key") == F.col("o_key")) & (F.col("bin") == F.col("o_bin")) & close & apart, "left_semi").select(*parts.columns).distinct()


def scan(df: DataFrame, scope: int = 256, id_col: str = "doc_id", text_col: str = "text", keep: bool = False) -> DataFrame:
    """One row per input row: id, ``base`` and ``spans`` (arrays of start, kind, stop; kinds as ``KINDS`` lists them).

    With ``keep`` there is also ``row``, a struct of all columns by position (``_c0`` and so on).

    ``base`` holds the strong spans, ``spans`` these and the linked weak ones. Null and empty texts have none;
    repeated rows stay repeated, each with its spans; null ids stay null; an empty table gives an empty one; other
    columns are left out, whatever their names. Spans of several kinds may overlap; ties go by kind.
    """
    rows = pick(df, **{id_col: "bigint", text_col: "string"})
    kept = ["row"] if keep else []
    if keep:
        plain = df.toDF(*(f"_c{i}" for i in range(len(df.columns))))
        ids, texts = (plain[f"_c{place(df, c)}"] for c in (id_col, text_col))
        rows = plain.select(ids.cast("bigint").alias(id_col), texts.cast("string").alias(text_col), F.struct("*").alias("row"))
    text = F.coalesce(F.col(text_col), F.lit(""))
    assigned = matches(text, ASSIGN, 0)
    value = lambda s: F.length(F.regexp_extract(s["found"], f"^(?:{ASSIGN})$", 2))
    rows = rows.select(id_col, text_col, *kept, assigned.alias("assigned"), matches(text, ACCESS, 1).alias("access"), matches(text, HEX, 2).alias("hex"))
    rows = rows.select(
        id_col, text_col, *kept,
        _bare(F.filter("assigned", lambda s: value(s) >= 8)).alias("assign"),
        _bare(F.filter("assigned", lambda s: (value(s) >= 4) & (value(s) < 8))).alias("short"),
        _bare(F.col("access")).alias("access"), _bare(F.col("hex")).alias("hex"),
        _bare(matches(text, KEY, 3)).alias("key40"), _bare(matches(text, IDENTIFIER, 4)).alias("ident"), _bare(matches(text, ENDPOINT, 5)).alias("endpoint"),
    )
    secrets = F.size("assign") + F.size("hex") + F.size("short") + F.size("key40")
    access = F.size("access") + F.size("ident")
    weak = F.size("short") + F.size("key40") + F.size("ident") + F.size("endpoint")
    rows = rows.select(
        id_col, *kept,
        F.concat("assign", "access", "hex").alias("base"),
        F.concat("assign", "hex").alias("secrets"), F.transform(F.concat("short", "key40"), lambda s: s.withField("kind", F.lit(3))).alias("weak_secrets"), "access", "ident", "endpoint",
        # equal rows have equal spans: the text's digest and the id name them
        F.when((weak > 0) & (secrets > 0) & (access > 0), F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.sha2(F.col(text_col).cast("binary"), 256))).alias("key"),
    )
    rows = stored(rows, "secrets")
    linkable = rows.filter("key is not null").dropDuplicates(["key"])
    parts = lambda *of: linkable.select("key", F.explode(F.concat(*of)).alias("s")).select("key", "s.*")
    all_access, all_secrets, endpoints = parts("access", "ident"), parts("secrets", "weak_secrets"), parts("endpoint")
    linked = _near(parts("weak_secrets"), all_access, scope)
    linked = linked.unionByName(_near(_near(parts("ident"), all_secrets, scope), endpoints, scope))
    linked = linked.unionByName(_near(_near(endpoints, all_access, scope), all_secrets, scope))
    linked = linked.groupBy("key").agg(F.collect_list(F.struct("start", "kind", "stop")).alias("linked"))
    none = F.array().cast(SPAN)
    # joined by a value of its own, so that the rows of a text that very many rows repeat can be split (see ``anew``)
    linked = linked.select(F.concat("key", F.lit("")).alias("of"), "linked")
    with_links = rows.filter("key is not null").join(linked, F.col("key") == F.col("of"), "left").select(id_col, *kept, "base", F.concat("base", F.coalesce("linked", none)).alias("spans"))
    return rows.filter("key is null").select(id_col, *kept, "base", F.col("base").alias("spans")).unionByName(with_links)


def digests(documents: DataFrame) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, base_sha256 and spans of every document."""
    count = lambda k: F.size(F.filter("base", lambda s: s["kind"] == k)).cast("bigint")
    return scan(documents).select("doc_id", count(0).alias("n_assign"), count(1).alias("n_access"), count(2).alias("n_hex"), F.sha2(told(F.col("base")).cast("binary"), 256).alias("base_sha256"), told(F.col("spans")).alias("spans"))


def redact(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", mark: str = "[secret]") -> DataFrame:
    """The rows of ``df``, all columns, with the text under every span of ``scan`` replaced by ``mark``.

    Overlapping spans become one mark; texts without spans, null and empty ones too, stay as they are; repeated rows
    stay repeated; null ids stay null; an empty table gives an empty one; columns of any name stay as they are.
    """
    rows = scan(df, id_col=id_col, text_col=text_col, keep=True)
    at = place(df, text_col)
    text = F.col("row")[f"_c{at}"]
    # an offset in a long text costs time in proportion, so it is cut into pieces once
    rows = rows.withColumn("spans", F.array_sort("spans")).withColumn("pieces", F.when(F.size("spans") > 0, F.regexp_extract_all(text, F.lit(f"(?s).{{1,{PIECE}}}"), F.lit(0))))
    rows = rows.withColumn("upto", running(F.transform("spans", lambda s: s["stop"]), lambda x, y: F.greatest(x, y)))

    def copy(a: Column, b: Column) -> Column:
        first = F.floor(a / PIECE).cast("int")
        whole = F.array_join(F.slice("pieces", first + 1, F.floor((b - 1) / PIECE).cast("int") - first + 1), "")
        return F.when(b > a, F.substring(whole, (a - first * PIECE + 1).cast("int"), (b - a).cast("int"))).otherwise("")

    before = lambda i: F.when(i > 0, F.get("upto", i - 1)).otherwise(0).cast("bigint")
    parts = F.transform("spans", lambda s, i: F.when(s["start"] >= before(i), F.concat(copy(before(i), s["start"]), F.lit(mark))).otherwise(""))
    end = copy(F.element_at("upto", -1), F.length(text).cast("bigint"))
    clean = F.when(F.size("spans") > 0, F.concat(F.array_join(parts, ""), end)).otherwise(text)
    return rows.select(*((clean if i == at else F.col("row")[f"_c{i}"]).alias(c) for i, c in enumerate(df.columns)))
