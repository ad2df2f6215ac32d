"""Row filters. Expressions return a Column, frame filters a DataFrame.

Time bounds come in as values resolved before the job, so that they reach the scan
as literals.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from sparkgauge.session import cut_lineage

EPOCH = dt.datetime(1970, 1, 1)


# Literal text within a name is first met by so many of its characters; shorter text by all of it.
GRAM = 3
KEY = ["_head", "_tail", "_text"]


def include_exclude(rows: DataFrame, name: str, include: DataFrame, exclude: DataFrame, pattern: str = "pattern") -> DataFrame:
    """Keep rows whose name is LIKE some include pattern and LIKE no exclude pattern.

    An empty include list keeps nothing, an empty exclude list removes nothing, null patterns
    are skipped, and a row without a name is LIKE none. Lists of any length are matched against
    the distinct names by their literal texts; no name meets all patterns.
    """
    names = cut_lineage(rows.select(F.col(name).alias("_name")).filter(F.col("_name").isNotNull()).distinct())
    listed = include.select(F.col(pattern).alias("_like"), F.lit(True).alias("_in")).unionByName(
        exclude.select(F.col(pattern).alias("_like"), F.lit(False).alias("_in"))
    )
    verdict = like_any(names, listed).groupBy("_name").agg(F.bool_and("_in").alias("_kept"))
    kept = cut_lineage(verdict.filter("_kept").select("_name"))
    return rows.join(kept, rows[name] == F.col("_name"), "left_semi")


def like_any(names: DataFrame, patterns: DataFrame) -> DataFrame:
    """Names (_name) with the flag (_in) of every pattern (_like) they are LIKE; pairs may repeat.

    A pattern without wildcards is equal to its names. Any other has keys: its two ends (text before
    the first and after the last wildcard) and each whole text between wildcards. It meets only the names
    that hold the key fewest names hold and is verified there. A pattern of wildcards alone is a
    condition on the length of a name.
    """
    listed = cut_lineage(parsed(patterns))
    ended = (F.col("_head") != "") | (F.col("_tail") != "")
    # Lengths only: no set is longer than the longest pattern.
    lengths = listed.filter("_whole IS NULL").agg(
        F.collect_set(F.when(F.col("_head") != "", F.length("_head"))).alias("heads"),
        F.collect_set(F.when((F.col("_head") == "") & (F.col("_tail") != ""), F.length("_tail"))).alias("tails"),
        F.array_distinct(F.flatten(F.collect_set(F.transform("_texts", lambda x: F.least(F.length(x), F.lit(GRAM)))))).alias("grams"),
        *[
            make(F.when(F.col("_wild") & (F.col("_in") == flag) & (F.contains("_like", F.lit("%")) == many), F.length(F.regexp_replace("_like", "%", "")))).alias(f"{kind}_{flag}")
            for flag in (True, False)
            for kind, many, make in (("least", True, F.min), ("fixed", False, F.collect_set))
        ],
    ).first()

    equal = names.join(listed.filter("_whole IS NOT NULL").select(F.col("_whole").alias("_name"), "_in"), "_name").select("_name", "_in")
    wanted = listed.filter("_whole IS NULL").filter(ended).select("_like", "_in", "_head", "_tail", F.lit("").alias("_text"))
    wanted = wanted.unionByName(
        listed.filter("_whole IS NULL").select("_like", "_in", F.lit("").alias("_head"), F.lit("").alias("_tail"), F.explode("_texts").alias("_text"))
    )
    # Written, so that few keys are known to be few and the names stay where they are.
    wanted = cut_lineage(wanted)
    keys = wanted.select(*KEY).distinct()
    held = [f(names, keys, sorted(lengths[k])) for f, k in ((held_heads, "heads"), (held_tails, "tails"), (held_texts, "grams")) if lengths[k]]
    found = equal
    if held:
        index = cut_lineage(reduce(DataFrame.unionByName, held))
        counts = index.groupBy(*KEY).agg(F.count("*").alias("_n"))
        # A key that no name holds is the rarest: its pattern is LIKE nothing and finds nothing.
        rarest = (
            wanted.join(counts, KEY, "left")
            .groupBy("_like", "_in")
            .agg(F.min(F.struct(F.coalesce("_n", F.lit(0)).alias("n"), *KEY)).alias("_r"))
            .select("_like", "_in", *[F.col(f"_r.{k}") for k in KEY])
        )
        found = found.unionByName(index.join(rarest, KEY).filter(F.like(F.col("_name"), F.col("_like"))).select("_name", "_in"))

    # Of the open ones the shortest decides, of the others their lengths.
    n = F.length("_name")
    for flag in (True, False):
        least, fixed = lengths[f"least_{flag}"], lengths[f"fixed_{flag}"]
        if least is not None or fixed:
            met = n.isin(*fixed) | (n >= least if least is not None else F.lit(False))
            found = found.unionByName(names.filter(met).select("_name", F.lit(flag).alias("_in")))
    return found


def parsed(patterns: DataFrame) -> DataFrame:
    """Distinct patterns with their literal texts, escapes resolved.

    _whole is the text of one without wildcards, else null; _head and _tail are the texts before the
    first and after the last wildcard, _texts those between, and _wild marks wildcards alone.
    """

    def resolved(text):
        return F.regexp_replace(text, r"(?s)\\(.)", "$1")

    def literal(text):
        return ~text.rlike("^[%_]")

    def end(at):
        return F.when(literal(at), resolved(at)).otherwise("")

    # Runs of wildcards and of literal characters take turns.
    tokens = F.regexp_extract_all(F.col("_like"), F.lit(r"(?s)((?:[^%_\\]++|\\.)++|[%_]++)"), F.lit(1))
    runs, size = F.col("_runs"), F.size("_runs")
    return (
        patterns.filter(F.col("_like").isNotNull())
        .select("_like", "_in")
        .distinct()
        .withColumn("_runs", tokens)
        .select(
            "_like",
            "_in",
            F.when(F.col("_like").rlike(r"\A(?:[^%_\\]++|\\[%_\\])*+\z"), resolved(F.col("_like"))).alias("_whole"),
            F.when(size > 0, end(F.get(runs, F.lit(0)))).otherwise("").alias("_head"),
            F.when(size > 1, end(F.get(runs, size - 1))).otherwise("").alias("_tail"),
            F.array_distinct(F.transform(F.filter(F.slice(runs, 2, F.greatest(size - 2, F.lit(0))), literal), resolved)).alias("_texts"),
            ((size == 1) & ~literal(F.get(runs, F.lit(0)))).alias("_wild"),
        )
    )


def held_heads(names: DataFrame, keys: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """Names with the ends they hold of those that have a head: a head found tells the lengths of its tails."""
    heads = keys.filter("_head <> ''").groupBy("_head").agg(F.collect_set(F.length("_tail")).alias("_sizes"))
    starts = names.select("_name", F.explode(F.lit(list(sizes))).alias("_n")).filter("_n <= length(_name)")
    begun = starts.select("_name", F.left("_name", "_n").alias("_head")).join(heads, "_head")
    ends = begun.select("_name", "_head", F.explode("_sizes").alias("_n")).filter("length(_head) + _n <= length(_name)")
    return ends.select("_name", "_head", F.right("_name", "_n").alias("_tail"), F.lit("").alias("_text")).join(keys, KEY, "left_semi").select("_name", *KEY)


def held_tails(names: DataFrame, keys: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """Names with the tails they hold of patterns that begin with a wildcard."""
    ends = names.select("_name", F.explode(F.lit(list(sizes))).alias("_n")).filter("_n <= length(_name)")
    ends = ends.select("_name", F.lit("").alias("_head"), F.right("_name", "_n").alias("_tail"), F.lit("").alias("_text"))
    return ends.join(keys, KEY, "left_semi").select("_name", *KEY)


def held_texts(names: DataFrame, keys: DataFrame, sizes: Sequence[int]) -> DataFrame:
    """Names with the whole texts they hold: the first characters found tell the lengths of the texts they begin."""
    texts = keys.filter("_text <> ''")
    grams = texts.groupBy(F.left("_text", F.lit(GRAM)).alias("_gram")).agg(F.collect_set(F.length("_text")).alias("_sizes"))
    places = names.filter("length(_name) > 0").select("_name", F.explode(F.sequence(F.lit(1), F.length("_name"))).alias("_at"))
    pieces = [F.when(F.col("_at") + n - 1 <= F.length("_name"), F.substr("_name", "_at", F.lit(n))) for n in sizes]
    begun = places.select("_name", "_at", F.explode(F.array(*pieces)).alias("_gram")).join(grams, "_gram")
    whole = begun.select("_name", "_at", F.explode("_sizes").alias("_n")).filter("_at + _n - 1 <= length(_name)")
    whole = whole.select("_name", F.lit("").alias("_head"), F.lit("").alias("_tail"), F.substr("_name", "_at", "_n").alias("_text"))
    return whole.join(texts, KEY, "left_semi").select("_name", *KEY).distinct()


def any_of(conditions: Sequence[Column]) -> Column:
    """Disjunction as a balanced tree, so that many terms do not nest deeply; false for none."""
    terms = list(conditions) or [F.lit(False)]
    while len(terms) > 1:
        terms = [terms[i] | terms[i + 1] if i + 1 < len(terms) else terms[i] for i in range(0, len(terms), 2)]
    return terms[0]


def like_lists(name: Column, include: Sequence[str], exclude: Sequence[str] = ()) -> Column:
    """The same rule for pattern lists that are parameters of the job: no join at all."""
    kept = any_of([name.like(p) for p in include])
    return kept & ~any_of([name.like(p) for p in exclude]) if exclude else kept


def bound(as_of: dt.datetime, mark: dt.datetime | None, **lookback: float) -> dt.datetime:
    """Later of the last processed time and ``as_of`` minus the lookback."""
    return max(mark or EPOCH, as_of - dt.timedelta(**lookback))


def since_last_run(rows: DataFrame, ts: str, as_of: dt.datetime, mark: dt.datetime | None, **lookback: float) -> DataFrame:
    """Rows strictly newer than the bound; the literal reaches the parquet scan."""
    return rows.filter(F.col(ts) > F.lit(bound(as_of, mark, **lookback)))


def any_time_newer(rows: DataFrame, times: Sequence[str], after: dt.datetime) -> DataFrame:
    """Rows whose latest non-null time is newer than the mark."""
    return rows.filter(F.greatest(*[F.col(c) for c in times]) > F.lit(after))


def database_scope(
    name: Column,
    allowed: Sequence[str] = (),
    *,
    own: str,
    family: str,
    cross_tenant: bool = True,
) -> Column:
    """Allow-list of name patterns (empty = all); names of the own family only if own or cross-tenant is on."""
    db = F.coalesce(name, F.lit(""))
    listed = any_of([db.like(p) for p in allowed]) if allowed else F.lit(True)
    return listed & (~db.like(family) | (db == own) | F.lit(cross_tenant))


def event_log_noise(
    *,
    scope: Column,
    value: Column,
    record_type: Column,
    database: Column,
    severity: Column,
    application: Column,
    own_scope: str,
    family: str,
    echo: str = "Sent log%Sent log%",
    quiet: Sequence[str] = ("DEBUG", "INFO"),
    loud_applications: Sequence[str] = ("openflow",),
) -> Column:
    """Keep log records worth reporting; a null scope, value or type drops the row (three-valued logic)."""
    return (
        ~scope.rlike(f"^(?:{own_scope})$")
        & ~value.like(echo)
        & ~record_type.isin("METRIC", "SPAN")
        & (~F.coalesce(database, F.lit("")).like(family) | ~severity.isin(*quiet))
        & (application.isNull() | ~application.isin(*loud_applications))
    )


def system_noise(text: Column, user: Column, role: Column, database: Column, schema: Column) -> Column:
    """True for empty statements of the system user without role, database and schema."""
    return F.coalesce(
        (text == "") & (user == "SYSTEM") & role.isNull() & database.isNull() & schema.isNull(), F.lit(False)
    )


def status_allow_list(status: Column, allowed: Iterable[str]) -> Column:
    """Listed statuses; an empty list keeps every row."""
    listed = list(allowed)
    return status.isin(*listed) if listed else F.lit(True)


def affected_queries(rows: DataFrame, slow_ms: int = 10_000) -> DataFrame:
    """Statements worth a closer look: spilled, queued, blocked, repaired, scanned > 90 % or slow."""
    c = F.col
    return rows.filter(
        c("query_type").isin("SELECT", "INSERT", "UPDATE")
        & ~c("user_name").isin("SYSTEM")
        & (
            (c("bytes_spilled_local") > 0)
            | (c("bytes_spilled_remote") > 0)
            | (c("queued_overload_time") > 0)
            | (c("queued_provisioning_time") > 0)
            | (c("partitions_scanned") * 10 > c("partitions_total") * 9)
            | (c("transaction_blocked_time") > 0)
            | (c("queued_repair_time") > 0)
            | (c("execution_time") > slow_ms)
        )
    )


# Fixed value: the only form of a statement id that is passed on.
SAFE_ID = r"^[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}$"


def acceleration_candidates(rows: DataFrame, query_id: str = "query_id", slow_ms: int = 10_000) -> DataFrame:
    """Slow statements that did not spill and scanned less than 90 % of their partitions."""
    c = F.col
    return rows.filter(
        (c("execution_time") > slow_ms)
        & (c("bytes_spilled_local") == 0)
        & (c("bytes_spilled_remote") == 0)
        & (c("partitions_scanned") * 10 < c("partitions_total") * 9)
        & c(query_id).rlike(SAFE_ID)
    )


def optional_selector(field: Column, selected: str | Sequence[str] | None, *, null_passes: bool = True) -> Column:
    """A dashboard variable: ``*`` or None keeps all; a null field passes unless told otherwise."""
    if selected is None or selected == "*":
        return F.lit(True)
    wanted = [selected] if isinstance(selected, str) else list(selected)
    chosen = F.coalesce(field.isin(*wanted), F.lit(False))
    return field.isNull() | chosen if null_passes else chosen


def filter_out(rows: DataFrame, condition: Column) -> DataFrame:
    """Remove rows where the condition holds; null does not count as true."""
    return rows.filter(~F.coalesce(condition, F.lit(False)))


def recent_timestamp_events(rows: DataFrame, times: str, mark_ns: int, *keep: str) -> DataFrame:
    """One row per event timestamp at or after the last mark."""
    return rows.select(*keep, F.explode(times).alias("trigger", "event_ns")).filter(F.col("event_ns") >= mark_ns)


def not_deleted(rows: DataFrame, deleted_on: str, since: dt.datetime | None = None) -> DataFrame:
    """Rows without a deletion, or deleted after the given moment."""
    alive = F.col(deleted_on).isNull()
    return rows.filter(alive if since is None else alive | (F.col(deleted_on) > F.lit(since)))


def prefix_any(field: Column, prefixes: Sequence[str], separator: str = "_") -> Column:
    """The field starts with one of the prefixes and the separator."""
    return any_of([field.startswith(p + separator) for p in prefixes])
