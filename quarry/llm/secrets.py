"""Secret scans with corpus-wide ownership frequency, in DataFrame functions only.

Patterns find base spans in every text. Besides them, every long run of key
characters with a digit and letters of either case is a candidate. All values
found are hashed and counted over the corpus: in how many repositories and
under how many owners does a value occur? A value that only one owner has, in
few repositories, looks like a live credential, and a candidate of that kind
becomes a span of its own; a value that owners share, or that one owner has
copied through many repositories, is an example.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import join_hot, settle

#: Kinds in the order in which spans of equal starts stand.
KINDS = ("assign", "access", "hex", "owned")
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
#: Runs are greedy, so a run that is too short for its kind holds no longer one: the least length may stand in the pattern.
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"(?<![0-9a-f])[0-9a-f]{24,}"
CANDIDATE = r"(?<![A-Za-z0-9+/_-])[A-Za-z0-9+/_-]{24,}"
ASSIGN_LEAST = 6
#: A value of more owners, or of more repositories, is a copied example.
MOST_OWNERS, MOST_REPOSITORIES = 1, 3
#: Matches, or spans, of one text that are folded at once: what is done for each of them grows with this, not with all of them.
FOLD = 256
#: Spans of up to this many bytes are broadcast to the texts; more are joined by a shuffle.
BROADCAST_BYTES = 64 << 20

#: In this order spans sort by place and kind.
_SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def _bound(value: Column, use) -> Column:
    """`use(value)` with the value worked out once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def _folds(values: Column, each) -> Column:
    """`each(part)` for every FOLD of the values, in order."""
    return F.transform(F.sequence(F.lit(0), F.floor((F.greatest(F.size(values), F.lit(1)) - 1) / FOLD).cast("int")), lambda k: each(F.slice(values, k * FOLD + 1, FOLD)))


def _before(sizes: Column) -> Column:
    """The sum of the values before each."""
    return F.aggregate(sizes, F.array(F.lit(0)), lambda acc, n: F.concat(acc, F.array(F.element_at(acc, -1) + n)))


def _spans(text: Column, pattern: str, kind: int, value=lambda m: m, accept=None) -> Column:
    """All leftmost non-overlapping matches with their places in code points.

    Splitting at the matches gives what lies between them; the lengths of both
    add up to each match's place, within a fold and then over the folds.
    """
    between, found = F.split(text, pattern, -1), F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    zero = F.struct(F.lit(0).alias("at"), F.array().cast(_SPAN).alias("spans"))

    def step(acc: Column, x: Column) -> Column:
        start = acc["at"] + F.length(x["b"])
        end = start + F.length(x["m"])
        span = F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), value(x["m"]).alias("value"))
        kept = F.array(span).cast(_SPAN)
        if accept is not None:
            kept = F.when(accept(value(x["m"])), kept).otherwise(F.array().cast(_SPAN))
        return F.struct(end.alias("at"), F.concat(acc["spans"], kept).alias("spans"))

    def placed(folds: Column) -> Column:
        moved = lambda f, n: F.transform(f["spans"], lambda s: F.struct((s["start"] + n).alias("start"), s["kind"].alias("kind"), (s["end"] + n).alias("end"), s["value"].alias("value")))
        starts = F.slice(_before(F.transform(folds, lambda f: f["at"])), 1, F.size(folds))
        return F.flatten(F.zip_with(folds, starts, moved)).cast(_SPAN)

    matches = F.zip_with(F.slice(between, 1, F.size(found)), found, lambda b, m: F.struct(b.alias("b"), m.alias("m")))
    all_of = lambda m: _bound(_folds(m, lambda part: F.aggregate(part, zero, step)), placed)
    return F.when(text.rlike(pattern), _bound(matches, all_of)).otherwise(F.array().cast(_SPAN))


def base_spans(text: Column) -> Column:
    """Base spans of a text, by start and then kind."""
    assigned = _spans(text, ASSIGN, 0, lambda m: F.regexp_extract(m, ASSIGN, 2), lambda v: F.length(v) >= ASSIGN_LEAST)
    return F.array_sort(F.concat(assigned, _spans(text, ACCESS, 1), _spans(text, HEX, 2)))


def _apart(base: Column, wide: Column) -> Column:
    """The spans of `wide`, disjoint ones, that overlap none of `base`: one walk over all in order of their places.

    `to` is where the base spans so far end; `held` is the last candidate, which
    the next base span may still overlap.
    """
    none = F.lit(None).cast(_SPAN[6:-1])
    one = lambda s: F.when(s.isNull(), F.array().cast(_SPAN)).otherwise(F.array(s).cast(_SPAN))

    def step(acc: Column, s: Column) -> Column:
        is_base = s["kind"] < 3
        hit = is_base & (s["start"] < acc["held"]["end"])
        held = F.when(is_base | (s["start"] < acc["to"]), none).otherwise(s)
        out = F.when(F.coalesce(hit, F.lit(False)), acc["out"]).otherwise(F.concat(acc["out"], one(acc["held"])))
        return F.struct(F.when(is_base, F.greatest(acc["to"], s["end"])).otherwise(acc["to"]).alias("to"), held.alias("held"), out.alias("out"))

    def fold(acc: Column, part: Column) -> Column:
        zero = F.struct(acc["to"].alias("to"), acc["held"].alias("held"), F.array().cast(_SPAN).alias("out"))
        done = lambda x: F.struct(x["to"].alias("to"), x["held"].alias("held"), F.concat(acc["out"], F.array(x["out"])).alias("out"))
        return F.aggregate(part, zero, step, done)

    zero = F.struct(F.lit(0).alias("to"), none.alias("held"), F.array().cast(f"array<{_SPAN}>").alias("out"))
    walk = lambda spans: F.aggregate(_folds(spans, lambda part: part), zero, fold, lambda acc: F.concat(F.flatten(acc["out"]), one(acc["held"])))
    return F.when((F.size(wide) == 0) | (F.size(base) == 0), wide).otherwise(_bound(F.array_sort(F.concat(base, wide)), walk))


def _found(docs: DataFrame, id_col: str, text_col: str, repository: Column | None, owner: Column | None, most_owners: int, most_repositories: int) -> tuple[DataFrame, DataFrame]:
    """(id, h) of every row, and (id, h, spans) of the rows that have any; h is a hash of the text."""
    repository = F.col("source") if repository is None else repository
    owner = F.col("source") if owner is None else owner
    text = F.coalesce(F.col(text_col), F.lit(""))
    looks = lambda v: v.rlike("[0-9]") & v.rlike("[a-z]") & v.rlike("[A-Z]")
    found = docs.select(
        F.col(id_col).alias("id"), F.xxhash64(text).alias("h"), F.coalesce(repository, F.lit("")).alias("repository"), F.coalesce(owner, F.lit("")).alias("owner"),
        base_spans(text).alias("base"), _spans(text, CANDIDATE, 3, accept=looks).alias("wide"),
    )
    found = settle(found.withColumn("wide", _apart(F.col("base"), F.col("wide"))))
    each = found.select("id", "h", "repository", "owner", F.explode(F.concat("base", "wide")).alias("span"))
    each = each.withColumn("value", F.sha2("span.value", 256))
    # Distinct owners and repositories are folded before the count, so that a value that all share sends a row for each, not for each place.
    owners = each.groupBy("value", "owner").agg(F.lit(1)).groupBy("value").agg(F.count("*").alias("owners"))
    repositories = each.groupBy("value", "repository").agg(F.lit(1)).groupBy("value").agg(F.count("*").alias("repositories"))
    # A value that stands in very many places isn't gathered in one task.
    known = join_hot(each.select("id", "h", "span", "value"), owners.join(repositories, "value"), ["value"])
    span = F.struct(*(F.col(f"span.{c}").alias(c) for c in ("start", "kind", "end", "value")), F.col("owners"), F.col("repositories"))
    known = known.where((F.col("span.kind") < 3) | (F.col("owners") <= most_owners) & (F.col("repositories") <= most_repositories))
    return found.select("id", "h"), known.groupBy("id", "h").agg(F.array_sort(F.collect_set(span)).alias("spans"))


def scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repository: Column | None = None, owner: Column | None = None, most_owners: int = MOST_OWNERS, most_repositories: int = MOST_REPOSITORIES) -> DataFrame:
    """(id, base, spans) for every row: arrays of (start, kind, end, value, owners, repositories).

    `base` has the base spans; `spans` also those that the method adds: the
    candidates that overlap no base span and whose value occurs under at most
    `most_owners` owners and in at most `most_repositories` repositories. Places are in code points, ends exclusive. A null
    text counts as empty. A null owner or repository counts as one of its own.
    Rows with null or repeated ids stay rows of their own. Texts are read once
    and never shuffled; only the found spans are.
    """
    rows, spans = _found(docs, id_col, text_col, repository, owner, most_owners, most_repositories)
    spans = spans.withColumnsRenamed({"id": "_id", "h": "_h"})
    out = rows.join(spans, rows["id"].eqNullSafe(spans["_id"]) & (rows["h"] == spans["_h"]), "left")
    empty = F.array().cast("array<struct<start:int,kind:int,end:int,value:string,owners:bigint,repositories:bigint>>")
    out = out.select(F.col("id").alias(id_col), F.coalesce("spans", empty).alias("spans"))
    return out.select(id_col, F.filter("spans", lambda s: s["kind"] < 3).alias("base"), "spans")


def redact(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", repository: Column | None = None, owner: Column | None = None, most_owners: int = MOST_OWNERS, most_repositories: int = MOST_REPOSITORIES, mask: str = "[SECRET]", keep: tuple[str, ...] = ()) -> DataFrame:
    """(id, text, columns of `keep`) for every row, with every run of spans of
    `scan` replaced by `mask`. Null texts stay null."""
    _, spans = _found(docs, id_col, text_col, repository, owner, most_owners, most_repositories)
    spans = settle(spans.select(F.col("id").alias("_id"), F.col("h").alias("_h"), F.transform("spans", lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end"))).alias("_spans")))
    size = spans.agg(F.sum(F.size("_spans") * 16 + 64)).first()[0] or 0
    spans = F.broadcast(spans) if size <= BROADCAST_BYTES else spans
    own = docs.select(F.col(id_col).alias("_own_id"), F.col(text_col).alias("_text"), F.xxhash64(F.coalesce(F.col(text_col), F.lit(""))).alias("_own_h"), *keep)
    out = own.join(spans, F.col("_own_id").eqNullSafe(F.col("_id")) & (F.col("_own_h") == F.col("_h")), "left")
    text = F.when(F.col("_spans").isNull(), F.col("_text")).otherwise(masked(F.col("_text"), F.col("_spans"), mask))
    return out.select(F.col("_own_id").alias(id_col), text.alias("text"), *keep)


def listed(spans: Column) -> Column:
    """`kind:start:end` of each span, comma-joined."""
    kind = lambda s: F.element_at(F.array(*map(F.lit, KINDS)), s["kind"] + 1)
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", kind(s), s["start"], s["end"])), ",")


def masked(text: Column, spans: Column, mask: str = "[SECRET]") -> Column:
    """`text` with every disjoint run of spans, which come by start, replaced by `mask`.

    Each fold of spans is applied to the stretch of text that begins where the
    spans before it end, so that the text as a whole is cut once for each fold.
    """
    kinds = "array<struct<part:array<struct<start:int,end:int>>,before:int,after:int>>"

    def step(part: Column, base: Column):
        def one(acc: Column, s: Column) -> Column:
            more = F.concat(acc["out"], F.substring(part, acc["at"] - base + 1, s["start"] - acc["at"]), F.lit(mask))
            return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.when(s["start"] >= acc["at"], more).otherwise(acc["out"]).alias("out"))

        return one

    def applied(f: Column) -> Column:
        part = F.substring(text, f["before"] + 1, f["after"] - f["before"])
        zero = F.struct(f["before"].alias("at"), F.lit("").alias("out"))
        return _bound(part, lambda p: F.aggregate(f["part"], zero, step(p, f["before"]), lambda acc: acc["out"]))

    def whole(folds: Column) -> Column:
        # Where the spans up to each fold end; places of one fold may lie before that.
        ends = F.aggregate(folds, F.array(F.lit(0)), lambda acc, f: F.concat(acc, F.array(F.greatest(F.element_at(acc, -1), F.array_max(F.transform(f, lambda s: s["end"]))))))
        told = lambda to: F.zip_with(folds, F.sequence(F.lit(1), F.size(folds)), lambda f, k: F.struct(f.alias("part"), F.element_at(to, k).alias("before"), F.element_at(to, k + 1).alias("after"))).cast(kinds)
        tail = lambda to: F.substring(text, F.element_at(to, -1) + 1, F.length(text))
        return _bound(ends, lambda to: F.concat(F.array_join(F.transform(told(to), applied), ""), tail(to)))

    places = F.transform(spans, lambda s: F.struct(s["start"].alias("start"), s["end"].alias("end")))
    return F.when(F.size(spans) == 0, text).otherwise(_bound(_folds(places, lambda part: part), whole))
