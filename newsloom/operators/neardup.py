"""Near-duplicate stories: who retells whom, and the greedy collapse.

Two stories are near duplicates if the smaller of their token signatures
shares at least ``threshold`` of its tokens with the other one (containment;
empty signatures match nothing).  The collapse goes through the ranking and
drops a story that is near a *kept* earlier one, so of a chain A~B~C with A
unlike C it keeps A and C.

How this scales
---------------
* Equal signatures first fold into their best-ranked member by one aggregate,
  so verbatim copies never meet in a join.
* The best-ranked stories, up to a fixed number, are scanned in rank order by
  one task that keeps an index of the kept ones.  No pair is listed, so a family
  of similar stories costs one comparison a member.
* Beyond that, stories are worked off in batches up to a fixed number.  The
  stories that the last batch keeps are broadcast as an index, and map tasks look
  every open story up in it where it lies: what is near one of them goes.  The
  best-ranked of what is left are the next batch and are scanned like the first.
  Tokens are whole numbers by then, and a look-up counts the tokens a story
  shares with every indexed one, so it is exact.  No pair and no key is listed,
  shuffled or stored; a round writes only the narrow rows that are still open.
  Time still grows with the square of the stories that are kept.
* :func:`first_distinct` finds the first few kept stories of many rankings at
  once, without collapsing any of them further than that.
"""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.text import token_signature
from ..lexicon import DEFAULT_LEXICON, Lexicon
from ..session import cut_lineage
from .numbering import numbered

THRESHOLD = 0.375


@dataclass(frozen=True)
class Tuning:
    """Speed settings; none of them changes the result."""

    frequent: int = 128  # a token in more signatures than this is frequent
    first_batch: int = 4096  # stories that one task scans, about 1 KB each
    growth: int = 8  # of the batches, up to
    batch: int = 32768  # stories that one task scans and that are broadcast, and
    held: int = 1_000_000  # tokens of them, 16 bytes each
    task: int = 4096  # open stories a map task looks up
    block: int = 256  # stories of one ranking that are scanned at a time


def signatures(df: DataFrame, rank: str, lexicon: Lexicon = DEFAULT_LEXICON) -> DataFrame:
    """(id, rank, tokens) of every story."""
    return df.select(F.col("article_id").alias("id"), F.col(rank).alias("rank"),
                     F.array_sort(token_signature(F.col("title"), F.col("summary"),
                                                  lexicon)).alias("tokens"))


def overlap(a: Column, b: Column) -> Column:
    """Number of tokens two signatures share."""
    return F.size(F.array_intersect(a, b))


def is_near(a: Column, b: Column, threshold: float = THRESHOLD) -> Column:
    """True if two signatures are near duplicates."""
    smaller = F.least(F.size(a), F.size(b))
    return (smaller > 0) & (overlap(a, b) / smaller >= threshold)


def _fold_copies(sigs: DataFrame) -> DataFrame:
    """One row per distinct signature, the best-ranked member; stories with an
    empty signature stay apart, each under its own id."""
    own = F.when(F.size("tokens") == 0, F.col("id"))
    return (sigs.groupBy("tokens", own.alias("own"))
            .agg(F.min(F.struct("rank", "id")).alias("first"))
            .select("first.id", "first.rank", "tokens"))


# Near pairs by joins on keys, a second way to the same pairs: if a story of m
# tokens, rare ones first, needs o shared ones, some shared token stands among its
# first m-o+1 and two among its first m-o+2.  Rare tokens are keys on their own,
# frequent ones only in pairs.  A story has a hundred keys and more, each with its
# tokens, so the collapse does not take this way.

def _prepare(stories: DataFrame, threshold: float, tuning: Tuning) -> DataFrame:
    """Order every signature's tokens and add the key material."""
    m = F.size("tokens")
    # Rounding down a hair can only lengthen the prefix.
    needed = F.greatest(F.ceil(m * F.lit(threshold) - F.lit(1e-9)), F.lit(1)).cast("int")
    each = stories.select("id", "rank", m.alias("m"), needed.alias("needed"),
                          F.explode_outer("tokens").alias("token"))
    held = (each.where("token IS NOT NULL").groupBy("token")
            .agg(F.count(F.lit(1)).alias("df"), F.max(F.col("needed") == 1).alias("asked"))
            .where(F.col("df") > tuning.frequent))
    # The list of frequent tokens is small unless the vocabulary is extreme;
    # adaptive execution broadcasts it only after measuring its size.
    ordered = (each.join(held, "token", "left")
               .groupBy("id", "rank", "m", "needed")
               .agg(F.array_sort(F.collect_list(F.when(F.col("token").isNotNull(), F.struct(
                   F.coalesce("df", F.lit(0)).alias("df"), "token",
                   F.coalesce("asked", F.lit(False)).alias("asked"))))).alias("t")))
    return ordered.select(
        "id", "rank", F.transform("t", lambda x: x["token"]).alias("tokens"), "m", "needed",
        F.size(F.filter("t", lambda x: x["df"] == 0)).alias("n_rare"),
        F.transform("t", lambda x: F.xxhash64(x["token"])).alias("codes"),
        F.transform(F.filter("t", lambda x: x["asked"]), lambda x: F.xxhash64(x["token"]))
        .alias("asked"))


def _keys(rows: DataFrame, probing: bool) -> DataFrame:
    """One row per join key.  The probing side (the smaller signature) needs
    only the keys of its prefix, the other side offers all of its keys."""
    m, n_rare, needed = F.col("m"), F.col("n_rare"), F.col("needed")
    none = F.array().cast("array<bigint>")
    single = needed == 1
    reach = m - needed if probing else m
    rare = F.slice("codes", F.lit(1), F.least(n_rare, reach + 1))
    frequent_n = F.greatest(F.least(m, reach + 2) - n_rare, F.lit(0))
    frequent = F.slice("codes", n_rare + 1, frequent_n)
    pairs = F.flatten(F.transform(frequent, lambda a, i: F.transform(
        F.slice(frequent, i + 2, F.greatest(F.size(frequent) - i - 1, F.lit(0))),
        lambda b: F.xxhash64(F.lit("pair"), a, b))))
    # A story that needs one shared token probes with single ones, no other does.
    parts = [F.transform(rare, lambda a: F.xxhash64(F.lit("one"), a)),
             F.when(single & F.lit(probing), none).otherwise(pairs),
             F.when(single | F.lit(not probing), F.transform(
                 "asked", lambda a: F.xxhash64(F.lit("any"), a))).otherwise(none)]
    return rows.select("id", "rank", "tokens", "codes", "m", F.explode(F.concat(*parts)).alias("key"))


def _joined(small: DataFrame, large: DataFrame, threshold: float) -> DataFrame:
    """Verified pairs (s, l) in which s has the smaller signature."""
    s, l = _keys(small, True).alias("s"), _keys(large, False).alias("l")
    smaller_first = ((F.col("s.m") < F.col("l.m"))
                     | ((F.col("s.m") == F.col("l.m")) & (F.col("s.id") < F.col("l.id"))))
    on = (F.col("s.key") == F.col("l.key")) & smaller_first
    # Whole-number codes settle most candidates much faster than text.  Equal
    # tokens have equal codes, so the codes share at least as many elements,
    # unless two tokens of one story collide: then only the text decides.
    by_code = (overlap(F.col("s.codes"), F.col("l.codes")) / F.col("s.m") >= threshold)
    collides = F.size(F.array_distinct("s.codes")) < F.col("s.m")
    near = overlap(F.col("s.tokens"), F.col("l.tokens")) / F.col("s.m") >= threshold
    # Keys are many times the stored rows they come from, by whose size Spark would
    # choose a broadcast, so both sides are shuffled at every size.
    # One condition, cheapest part first: Spark keeps the order.
    return s.hint("merge").join(l.hint("merge"), on & (by_code | collides) & near)


def _pairs_within(rows: DataFrame, threshold: float) -> DataFrame:
    """Near pairs inside one batch as (early, late) by rank."""
    s = F.struct(F.col("s.rank").alias("rank"), F.col("s.id").alias("id"))
    l = F.struct(F.col("l.rank").alias("rank"), F.col("l.id").alias("id"))
    return (_joined(rows, rows, threshold)
            .select(F.least(s, l).alias("early"), F.greatest(s, l).alias("late")).distinct())


def _first_leader(leaders: DataFrame, rest: DataFrame, threshold: float) -> DataFrame:
    """For each later story near a leader, its best-ranked one."""
    def side(leader: str, other: str) -> list[Column]:
        return [F.col(f"{other}.id").alias("id"),
                F.struct(F.col(f"{leader}.rank").alias("rank"),
                         F.col(f"{leader}.id").alias("id")).alias("leader")]

    found = (_joined(leaders, rest, threshold).select(*side("s", "l"))
             .unionByName(_joined(rest, leaders, threshold).select(*side("l", "s"))))
    return found.groupBy("id").agg(F.min("leader").alias("leader"))


# The scan in rank order.

class _Kept:
    """Stories kept so far and an index of their tokens."""

    def __init__(self, threshold: float) -> None:
        self.threshold = threshold
        self.sizes: list[int] = []
        self.holders: dict[str, list[int]] = defaultdict(list)

    def first_near(self, tokens: Sequence[str]) -> int | None:
        """The number of the first kept story that is near, if any."""
        shared: Counter = Counter()
        for token in tokens:
            shared.update(self.holders.get(token, ()))
        return min((k for k, n in shared.items()
                    if n / min(len(tokens), self.sizes[k]) >= self.threshold), default=None)

    def add(self, tokens: Sequence[str]) -> None:
        for token in tokens:
            self.holders[token].append(len(self.sizes))
        self.sizes.append(len(tokens))


_NAME = pa.struct([("rank", pa.int64()), ("id", pa.string())])
_LEADER = "leader struct<rank: long, id: string>"


def _scanned(rows: DataFrame, threshold: float) -> DataFrame:
    """(id, rank, tokens, leader) of few rows, by one scan in rank order."""
    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("rank", "ascending"), ("id", "ascending")])
        kept, names, leaders = _Kept(threshold), [], []
        for rank, name, tokens in zip(*(table.column(c).to_pylist() for c in ("rank", "id", "tokens"))):
            near = kept.first_near(tokens)
            leaders.append(None if near is None else names[near])
            if near is None:
                kept.add(tokens)
                names.append({"rank": rank, "id": name})
        return table.select(["id", "rank", "tokens"]).append_column("leader", pa.array(leaders, _NAME))

    return rows.select("id", "rank", "tokens", F.lit(0).alias("_all")).groupBy("_all").applyInArrow(
        run, f"id string, rank long, tokens array<string>, {_LEADER}")


def _enough(sizes: np.ndarray, threshold: float) -> np.ndarray:
    """The fewest shared tokens that make a story near one of ``sizes`` tokens, if
    that is the smaller one."""
    sizes = np.maximum(sizes, 1)
    least = np.maximum(np.ceil(threshold * sizes), 1).astype(np.int64)
    least += least / sizes < threshold  # a product may be a hair off
    return least - ((least > 1) & ((least - 1) / sizes >= threshold))


@lru_cache(4096)
def _own_enough(size: int, threshold: float) -> int:
    return int(_enough(np.array([size]), threshold)[0])


class _Index:
    """Stories by their number in rank order, and for every token its holders."""

    def __init__(self, stories: Sequence[np.ndarray], threshold: float) -> None:
        sizes = np.fromiter(map(len, stories), np.int64, len(stories))
        tokens = np.concatenate([np.empty(0, np.int64), *stories])
        order = np.argsort(tokens, kind="stable")
        self.holders = np.repeat(np.arange(len(stories)), sizes)[order]
        self.tokens, start = np.unique(tokens[order], return_index=True)
        self.bounds = np.append(start, len(tokens))
        self.enough = _enough(sizes, threshold)
        self.threshold = threshold

    def near(self, tokens: np.ndarray) -> np.ndarray:
        """Which stories are near."""
        at = np.searchsorted(self.tokens, tokens)
        known = at < len(self.tokens)
        at = at[known][self.tokens[at[known]] == tokens[known]]
        if not len(at):
            return np.zeros(len(self.enough), bool)
        held = np.concatenate([self.holders[i:j] for i, j in zip(
            self.bounds[at].tolist(), self.bounds[at + 1].tolist())])
        # The smaller signature asks for fewer tokens, so the lesser number counts.
        enough = np.minimum(self.enough, _own_enough(len(tokens), self.threshold))
        return np.bincount(held, minlength=len(enough)) >= enough

    def first_near(self, tokens: np.ndarray) -> int | None:
        """The number of the first story that is near, if any."""
        near = self.near(tokens)
        first = int(near.argmax())
        return first if near[first] else None


class _Growing:
    """Kept stories in indexes of falling size, so that adding is cheap."""

    def __init__(self, threshold: float) -> None:
        self.threshold = threshold
        self.parts: list[tuple[list[np.ndarray], _Index]] = []

    def first_near(self, tokens: np.ndarray) -> int | None:
        """The number of the first kept story that is near, if any."""
        before = 0
        for stories, index in self.parts:
            near = index.first_near(tokens)
            if near is not None:
                return before + near
            before += len(stories)
        return None

    def add(self, stories: list[np.ndarray]) -> None:
        if not stories:
            return
        while self.parts and len(self.parts[-1][0]) <= 2 * len(stories):
            stories = self.parts.pop()[0] + stories
        self.parts.append((stories, _Index(stories, self.threshold)))


def _stories(batch: pa.RecordBatch) -> list[np.ndarray]:
    """The coded tokens of every row."""
    column = batch.column("tokens")
    ends = np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))
    return np.split(column.flatten().to_numpy(zero_copy_only=False), ends[:-1]) if len(ends) else []


def _with_leaders(batch: pa.RecordBatch, leaders: list[dict | None]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays(
        [*(batch.column(c) for c in ("id", "rank", "tokens")), pa.array(leaders, _NAME)],
        ["id", "rank", "tokens", "leader"])


_CODED = f"id string, rank long, tokens array<long>, {_LEADER}"


def _scanned_codes(rows: DataFrame, threshold: float, tuning: Tuning) -> DataFrame:
    """Like :func:`_scanned` over coded tokens.  It ends before the last row where the
    kept stories have ``tuning.held`` tokens; later rows do not come out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept, names, held = _Growing(threshold), [], 0
        for batch in batches:
            for start in range(0, batch.num_rows, tuning.block):
                if held >= tuning.held:
                    break
                part = batch.slice(start, tuning.block)
                stories = _stories(part)
                leaders = [kept.first_near(own) for own in stories]
                own_names = [{"rank": rank, "id": name} for rank, name in zip(
                    part.column("rank").to_pylist(), part.column("id").to_pylist())]
                out = [None if k is None else names[k] for k in leaders]
                # What is near none of the stories before this part is compared inside it.
                rows_left = [i for i, k in enumerate(leaders) if k is None]
                index = _Index([stories[i] for i in rows_left], threshold)
                stays = np.zeros(len(rows_left), bool)
                for k, i in enumerate(rows_left):
                    near = np.flatnonzero(index.near(stories[i]) & stays)
                    if len(near):
                        out[i] = own_names[rows_left[near[0]]]
                    else:
                        stays[k] = True
                fresh = [i for i, stay in zip(rows_left, stays) if stay]
                kept.add([stories[i] for i in fresh])
                names += [own_names[i] for i in fresh]
                held += sum(len(stories[i]) for i in fresh)
                yield _with_leaders(part, out)

    return (rows.select("id", "rank", "tokens").repartition(1).sortWithinPartitions("rank")
            .mapInArrow(run, _CODED))


def _looked_up(rest: DataFrame, leaders: DataFrame, threshold: float, tasks: int) -> DataFrame:
    """Later stories, each with the best-ranked of the ``leaders`` that it is near; stored.

    The leaders are collected and broadcast, so there must be few of them.
    """
    held = leaders.select("id", "rank", "tokens").toArrow().sort_by("rank").combine_chunks()
    stories = [own for batch in held.to_batches() for own in _stories(batch)]
    shared = rest.sparkSession.sparkContext.broadcast(
        (held.column("rank").to_pylist(), held.column("id").to_pylist(), _Index(stories, threshold)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ranks, names, index = shared.value
        for batch in batches:
            near = [index.first_near(own) for own in _stories(batch)]
            yield _with_leaders(batch, [None if k is None else {"rank": ranks[k], "id": names[k]}
                                        for k in near])

    # Little data and much work: dealt out by rows, not by bytes.
    found = cut_lineage(rest.select("id", "rank", "tokens").repartition(tasks, "rank")
                        .mapInArrow(run, _CODED), "near-leaders")
    shared.destroy()  # else every round's index stays on all executors
    return found


def _coded(stories: DataFrame) -> DataFrame:
    """Stories with a number in place of every token; equal tokens have equal numbers."""
    each = stories.select("id", "rank", F.explode_outer("tokens").alias("token"))
    # Stored, so the numbers are the same whenever they are read.
    codes = cut_lineage(each.select("token").where("token IS NOT NULL").distinct()
                        .withColumn("code", F.monotonically_increasing_id()), "token-codes")
    return (each.join(codes, "token", "left").groupBy("id", "rank")
            .agg(F.collect_list("code").alias("tokens")))


def _best(rest: DataFrame, n: int, of: int) -> DataFrame:
    """About the ``n`` best-ranked of ``of`` stories, one at least."""
    if of <= n:
        return rest
    cut = rest.agg(F.percentile_approx("rank", F.lit(n / of), F.lit(10000))).first()[0]
    return rest.where(F.col("rank") <= cut)


def near_duplicate_links(df: DataFrame, rank: str, threshold: float = THRESHOLD,
                         lexicon: Lexicon = DEFAULT_LEXICON,
                         tuning: Tuning = Tuning()) -> DataFrame:
    """Every story with the kept story it retells: (id, rank, leader).

    ``leader`` is NULL for stories that are kept themselves.  ``article_id``
    must be unique; ``rank`` names a number column, ties go by id.  Runs Spark
    jobs; the result is a stored table.
    """
    sigs = cut_lineage(signatures(df, rank, lexicon), "signatures")
    # From here on ``rank`` is the place in the order of rank and id.
    places = numbered(_fold_copies(sigs), ["rank", "id"], "story-order", "place")
    places = cut_lineage(places.select("id", F.col("place").alias("rank"), "tokens"), "places")
    size = tuning.first_batch
    decided = cut_lineage(_scanned(places.where(F.col("rank") < size), threshold), "decided")
    links = _verdicts(decided)
    left = places.count() - size  # else the scan saw them all
    if left > 0:
        coded = cut_lineage(_coded(places), "tokens")
        leaders = decided.filter("leader IS NULL").select("rank").join(coded, "rank")
        rest = coded.where(F.col("rank") >= size)
    while left > 0:
        looked_up = _looked_up(rest, leaders, threshold, math.ceil(left / tuning.task))
        links = links.unionByName(_verdicts(looked_up.where("leader IS NOT NULL")))
        rest = looked_up.where("leader IS NULL").drop("leader")
        left = rest.count()
        if not left:
            break
        size = min(size * tuning.growth, tuning.batch)
        decided = cut_lineage(_scanned_codes(_best(rest, size, left), threshold, tuning), "decided")
        links = links.unionByName(_verdicts(decided))
        leaders = decided.where("leader IS NULL").drop("leader")
        done, last = decided.agg(F.count("*"), F.max("rank")).first()
        rest, left = rest.where(F.col("rank") > last), left - done

    out = _members(sigs).join(links, "first_id").select(
        "id", "rank", F.coalesce("leader", F.when(F.col("id") != F.col("first_id"),
                                                  F.col("first_id"))).alias("leader"))
    return cut_lineage(out, "near-duplicates")


def _verdicts(decided: DataFrame) -> DataFrame:
    return decided.select(F.col("id").alias("first_id"), F.col("leader.id").alias("leader"))


def _members(sigs: DataFrame) -> DataFrame:
    """Every story with the first member of its group of equal signatures."""
    key = F.when(F.size("tokens") == 0, F.col("id")).otherwise(
        F.sha2(F.array_join("tokens", " "), 256))
    keyed = sigs.select("id", "rank", key.alias("k"))
    first = keyed.groupBy("k").agg(F.min(F.struct("rank", "id")).alias("f"))
    # Only groups with copies need the join; a large one is split by adaptive
    # skew handling, its other side being a single row.
    return keyed.join(first, "k").select("id", "rank", F.col("f.id").alias("first_id"))


def collapse_near_duplicates(df: DataFrame, rank: str, threshold: float = THRESHOLD,
                             lexicon: Lexicon = DEFAULT_LEXICON,
                             tuning: Tuning = Tuning()) -> DataFrame:
    """(article_id) of the stories that are kept."""
    links = near_duplicate_links(df, rank, threshold, lexicon, tuning)
    return links.filter("leader IS NULL").select(F.col("id").alias("article_id"))


def first_distinct(df: DataFrame, by: str, rank: str, n: int, threshold: float = THRESHOLD,
                   lexicon: Lexicon = DEFAULT_LEXICON, tuning: Tuning = Tuning()) -> DataFrame:
    """(by, article_id) of the first ``n`` stories of every ranking that no
    earlier kept one is near; ``by`` names the ranking and may be NULL.

    Each round takes the next block of every ranking that is not full, which map
    tasks cut to that many rows, and scans it against the few stories kept so
    far.  Before the block is taken, all stories near a kept one are removed
    where they are, so the first row of a block is always kept: there are at
    most ``n`` rounds, mostly one, and no task sees more than a block.
    Runs Spark jobs; the result is a stored table.
    """
    rows = df.select(F.col(by).alias("by"), F.col("article_id").alias("id"),
                     F.col(rank).cast("double").alias("rank"), "title", "summary")
    tokens = F.array_sort(token_signature(F.col("title"), F.col("summary"), lexicon))
    order = Window.partitionBy("by").orderBy("rank", "id")
    kind = df.schema[by].dataType.simpleString()
    schema = f"by {kind}, id string, rank double, tokens array<string>, fresh boolean"

    def run(table: pa.Table) -> pa.Table:
        table = table.sort_by([("fresh", "ascending"), ("rank", "ascending"), ("id", "ascending")])
        kept, chosen = _Kept(threshold), []
        for i, (own, fresh) in enumerate(zip(table.column("tokens").to_pylist(),
                                             table.column("fresh").to_pylist())):
            if len(chosen) < n and (not fresh or kept.first_near(own) is None):
                kept.add(own)
                chosen.append(i)
        return table.take(chosen).select(["by", "id", "rank", "tokens", "fresh"])

    def block(of: DataFrame) -> DataFrame:
        taken = of.withColumn("_place", F.row_number().over(order)).where(
            F.col("_place") <= tuning.block)
        return taken.select("by", "id", "rank", tokens.alias("tokens"), F.lit(True).alias("fresh"))

    def scanned(of: DataFrame, name: str) -> DataFrame:
        return cut_lineage(of.groupBy("by").applyInArrow(run, schema), name)

    kept = scanned(block(rows), "first-distinct")
    done = None
    while True:
        # Rankings that still want stories, with what they have: at most n signatures each.
        per = kept.groupBy(F.col("by").alias("open_by")).agg(
            F.count("*").alias("have"), F.collect_list("tokens").alias("held"),
            F.max(F.struct("rank", "id")).alias("last"))
        full = per.where(F.col("have") >= n).select("open_by")
        finished = kept.join(full, kept["by"].eqNullSafe(full["open_by"]), "left_semi")
        done = finished if done is None else done.unionByName(finished)
        wanting = per.where(F.col("have") < n)
        if wanting.isEmpty():
            break
        near = F.exists("held", lambda other: is_near(tokens, other, threshold))
        # Nothing before the last kept story can be kept any more.
        later = F.struct(F.col("rank"), F.col("id")) > F.col("last")
        left = (rows.join(wanting, F.col("by").eqNullSafe(F.col("open_by")) & later)
                .where(~near).select(*rows.columns))
        more = cut_lineage(block(left), "next-distinct")
        open_kept = kept.join(wanting, F.col("by").eqNullSafe(F.col("open_by"))).select(
            "by", "id", "rank", "tokens", F.lit(False).alias("fresh"))
        if more.isEmpty():
            done = done.unionByName(open_kept)
            break
        kept = scanned(open_kept.unionByName(more), "first-distinct")
    return done.select(F.col("by").alias(by), F.col("id").alias("article_id"))
