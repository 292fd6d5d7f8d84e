"""Entity resolution: inverted indexes, tiers, fuzzy joins and divisions."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import similarity as sim
from ..functions import text as T
from .lineage import cut
from .select import best_per_group


def name_index(names: DataFrame, entity: str, name: str, clean: bool = True) -> DataFrame:
    """Long table entity, variant_rank, variant, key: what a dictionary of names would hold."""
    v = T.variants(F.col(name), clean)
    rows = F.array(*[F.struct(F.lit(i).alias("variant_rank"), F.lit(n).alias("variant"), v[n].alias("key")) for i, n in enumerate(T.VARIANTS)])
    return names.select(entity, F.explode(rows).alias("r")).select(entity, "r.*").filter("key <> ''").distinct()


def unambiguous(index: DataFrame, entity: str, cap: int = C.NAME_CAP) -> DataFrame:
    """Keys that stand for at most cap entities. Hot keys leave by an aggregation before anything is joined."""
    few = index.groupBy("key").agg(F.count_distinct(entity).alias("_n")).filter(F.col("_n") <= cap).select("key")
    return index.join(few, "key", "left_semi")


def resolve_names(queries: DataFrame, query: str, index: DataFrame, entity: str, clean: bool = True) -> DataFrame:
    """Hits of the first variant that hits, for each query: query, entity, variant."""
    asked = name_index(queries.select(query).distinct().withColumn("_n", F.col(query)), query, "_n", clean)
    hits = asked.join(index.select("key", F.col(entity)).distinct(), "key")
    first = F.min("variant_rank").over(Window.partitionBy(query))
    return hits.withColumn("_first", first).filter("variant_rank = _first").select(query, entity, "variant").distinct()


def cascade(tiers: list[tuple[str, float, DataFrame]], left: str, right: str) -> DataFrame:
    """left, right, tier, method, score: the matches of the first tier that has any, for each left key. tiers: (method, score,
    DataFrame of left and right), best first. One union and one window instead of a chain of anti-joins."""
    rows = None
    for k, (method, score, matches) in enumerate(tiers):
        one = matches.select(left, right).withColumns({"tier": F.lit(k + 1), "method": F.lit(method), "score": F.lit(score)})
        rows = one if rows is None else rows.unionByName(one)
    least = F.min("tier").over(Window.partitionBy(left))
    return rows.distinct().withColumn("_least", least).filter("tier = _least").drop("_least")


#: Rows of a key in one block, and in how many tasks a key's rows are put into blocks.
BLOCK, SALTS = 1000, 8


def _blocks(rows: DataFrame, by: list[str], value: str, name: str) -> DataFrame:
    """by, and the values of each block of rows as an array of structs."""
    salted = rows.withColumn("_salt", F.pmod(F.xxhash64(value), F.lit(SALTS)))
    place = F.row_number().over(Window.partitionBy(*by, "_salt").orderBy(value))
    blocks = salted.withColumn("_block", F.floor((place - 1) / BLOCK)).groupBy(*by, "_salt", "_block").agg(F.collect_list(F.struct(value)).alias(name))
    return blocks.select(*by, F.struct("_salt", "_block").alias(f"{name}_at"), name)


def keyed_cascade(tiers: list[tuple[str, float, DataFrame, DataFrame]], left: str, right: str) -> DataFrame:
    """What ``cascade`` returns, of tiers that are equi-joins: (method, score, DataFrame of left and key, DataFrame of key and right),
    best first; the keys of all tiers have one type. A left key that is null has no match.

    The tier of each left key is found before any match is made. Blocks of left keys then meet blocks of right ones, are dealt out,
    and only there become rows: however many matches a key has, neither the shuffle nor one task grows with them. Matches are
    made once; only left keys with several keys in their tier can repeat one, and theirs alone are made distinct."""
    lefts = reduce(DataFrame.unionByName, [f.select(F.lit(k + 1).alias("tier"), "key", left) for k, (_, _, f, _) in enumerate(tiers)]).dropna().distinct()
    rights = reduce(DataFrame.unionByName, [f.select(F.lit(k + 1).alias("tier"), "key", right) for k, (*_, f) in enumerate(tiers)]).dropna(subset=["key"]).distinct()
    of_left = Window.partitionBy(left)
    found = lefts.join(rights.select("tier", "key"), ["tier", "key"], "left_semi")
    found = found.withColumn("_least", F.min("tier").over(of_left)).filter("tier = _least").withColumn("_many", F.count("*").over(of_left) > 1)
    parts = int(lefts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    right_blocks = _blocks(rights, ["tier", "key"], right, "_r")

    def made(rows: DataFrame) -> DataFrame:
        met = _blocks(rows, ["tier", "key"], left, "_l").join(right_blocks, ["tier", "key"]).repartition(parts, "tier", "key", "_l_at", "_r_at")
        return met.select("tier", "_r", F.inline("_l")).select("tier", left, F.inline("_r"))

    rows = made(found.filter("not _many")).unionByName(made(found.filter("_many")).distinct())
    of_tier = lambda place: F.element_at(F.array(*[F.lit(t[place]) for t in tiers]), F.col("tier"))
    return rows.select(left, right, "tier", of_tier(0).alias("method"), of_tier(1).alias("score"))


def preferred(matches: DataFrame, left: str, right: str, sizes: DataFrame, size: str) -> DataFrame:
    """Of each left key the match whose right side has the most (pathways), then the smallest id."""
    return best_per_group(matches.join(sizes, right, "left"), [left], [F.desc_nulls_last(size), F.asc(right)])


def fuzzy_join(a: DataFrame, a_name: str, b: DataFrame, b_name: str, most: int = 2, shortest: int = 6) -> DataFrame:
    """Pairs of names within ``most`` edits: an equi-join on deletion keys, then the exact distance. Names shorter than
    ``shortest`` match themselves alone."""
    left = a.select(a_name).distinct().withColumn("_k", F.explode(sim.deletion_keys(F.col(a_name), most, shortest)))
    right = b.select(b_name).distinct().withColumn("_k", F.explode(sim.deletion_keys(F.col(b_name), most, shortest)))
    pairs = left.join(right, "_k").select(a_name, b_name).distinct()
    return pairs.withColumn("distance", F.levenshtein(a_name, b_name)).filter(F.col("distance") <= most)


def length_pairs(a: DataFrame, a_name: str, b: DataFrame, b_name: str) -> DataFrame:
    """a_name, b_name: all pairs of names whose lengths are near. One name of each length is compared, then lengths are joined on."""
    left, right = a.select(a_name, F.length(a_name).alias("_la")), b.select(b_name, F.length(b_name).alias("_lb"))
    one, two = left.groupBy("_la").agg(F.min(a_name).alias("_a")), right.groupBy("_lb").agg(F.min(b_name).alias("_b"))
    lengths = one.join(two, sim.lengths_near(F.col("_a"), F.col("_b"))).select("_la", "_lb")
    return left.join(lengths, "_la").join(right, "_lb").select(a_name, b_name)


def shared_members(a: DataFrame, a_key: str, b: DataFrame, b_key: str, member: str) -> DataFrame:
    """a_key, b_key, n_common, n_a, n_b, jaccard, overlap of all pairs of sets that share a member: from one equi-join and counts,
    no set is ever gathered."""
    left, right = a.select(a_key, member).distinct(), b.select(b_key, member).distinct()
    sizes_a = left.groupBy(a_key).agg(F.count("*").alias("n_a"))
    sizes_b = right.groupBy(b_key).agg(F.count("*").alias("n_b"))
    common = left.join(right, member).groupBy(a_key, b_key).agg(F.count("*").alias("n_common"))
    rows = common.join(sizes_a, a_key).join(sizes_b, b_key)
    return rows.withColumn("jaccard", F.col("n_common") / (F.col("n_a") + F.col("n_b") - F.col("n_common"))).withColumn("overlap", F.col("n_common") / F.least("n_a", "n_b"))


def token_dice_join(a: DataFrame, a_key: str, a_tokens: Column, b: DataFrame, b_key: str, b_tokens: Column, least: float) -> DataFrame:
    """a_key, b_key, dice of all pairs with a token-set Dice of at least ``least`` (above 0).

    Sets are ordered from their rarest token on. Two that reach ``least`` share one of the first tokens, as many as a set can have
    besides its part in the smallest overlap allowed; only these are joined on, so a token that all texts have joins nothing. Sizes
    that can't reach ``least`` are out before sets are compared.
    """
    share = least / (2 - least)
    sets = [f.select(F.col(key).alias("k"), F.array_distinct(tokens).alias("set")).filter(F.size("set") > 0) for f, key, tokens in ((a, a_key, a_tokens), (b, b_key, b_tokens))]
    words = [f.select("k", F.size("set").alias("n"), F.explode("set").alias("t")) for f in sets]
    often = words[0].select("t").unionAll(words[1].select("t")).groupBy("t").agg(F.count("*").alias("df"))
    heads = []
    for w in words:
        ordered = w.join(often, "t").groupBy("k", "n").agg(F.array_sort(F.collect_list(F.struct("df", "t"))).alias("o"))
        first = F.slice("o", 1, F.col("n") - F.ceil(share * F.col("n") - 1e-9).cast("int") + 1)
        heads.append(ordered.select("k", "n", F.explode(first.getField("t")).alias("t")))
    one, two = heads[0].withColumnsRenamed({"k": "ka", "n": "na"}), heads[1].withColumnsRenamed({"k": "kb", "n": "nb"})
    near = F.least("na", "nb") >= share * F.greatest("na", "nb") - 1e-9
    pairs = one.join(two, "t").filter(near).select("ka", "kb").distinct()
    both = pairs.join(sets[0].withColumnsRenamed({"k": "ka", "set": "sa"}), "ka").join(sets[1].withColumnsRenamed({"k": "kb", "set": "sb"}), "kb")
    return both.withColumn("dice", sim.dice(F.col("sa"), F.col("sb"))).filter(F.col("dice") >= least).select(F.col("ka").alias(a_key), F.col("kb").alias(b_key), "dice")


def token_edit_join(a: DataFrame, a_name: str, b: DataFrame, b_name: str) -> DataFrame:
    """left, right: pairs of normalised names that are equal, differ in one token by one edit, or where one has one more token that
    may be ignored. Candidates share the whole name or what is left of it without one token."""
    left = a.select(F.col(a_name).alias("left")).distinct()
    right = b.select(F.col(b_name).alias("right")).distinct()
    keys = lambda c: F.explode(F.array_distinct(F.concat(F.array(c), T.token_deletions(c))))
    pairs = left.withColumn("_k", keys(F.col("left"))).join(right.withColumn("_k", keys(F.col("right"))), "_k").select("left", "right").distinct()
    return pairs.filter(T.within_one_token(F.split("left", " "), F.split("right", " ")))


def division(members: DataFrame, group: str, member: str, required: DataFrame) -> DataFrame:
    """Groups that hold every required member (relational division)."""
    needed = required.select(member).distinct()
    have = members.select(group, member).distinct().join(needed, member).groupBy(group).agg(F.count("*").alias("_n"))
    return have.crossJoin(F.broadcast(needed.agg(F.count("*").alias("_all")))).filter("_n = _all").select(group)


def roots(edges: DataFrame, child: str, parent: str) -> DataFrame:
    """child, root, depth of every child, by pointer doubling: a tree of any depth d takes about log2 d joins, and none once every
    pointer is at a root. A parent that is no child is a root. What leads into a cycle: the last member that a walk meets before
    it comes to a node again, depth -1."""
    children = edges.select(F.col(child).alias("up")).distinct().withColumn("open", F.lit(True))
    now = edges.select(F.col(child).alias("n"), F.col(parent).alias("up"), F.lit(1).cast("long").alias("depth"))
    now = cut(now.join(children, "up", "left").select("n", "up", "depth", F.coalesce("open", F.lit(False)).alias("open")))
    hops, open_before = 1, None
    while True:
        still_open = now.filter("open").agg(F.count_distinct("n")).first()[0]
        # Above a node deeper than this round's hops is one that the round closed, so if it closed none, only cycles are left;
        # they are walked on until all of their members are met.
        if not still_open or still_open == open_before and hops >= still_open:
            break
        open_before = still_open
        # Rows at a root are looked up but move no more.
        above = now.select(F.col("n").alias("up"), F.col("up").alias("_up"), F.col("depth").alias("_d"), F.col("open").alias("_open"))
        moved = now.filter("open").drop("open").join(above, "up").select("n", F.col("_up").alias("up"), (F.col("depth") + F.col("_d")).alias("depth"), F.col("_open").alias("open"))
        now = cut(now.filter("not open").unionByName(moved))
        hops *= 2
    done = now.filter("not open").select(F.col("n").alias(child), F.col("up").alias("root"), "depth")
    if not still_open:
        return done
    # What is still open leads into cycles; after so many hops its pointers are the cycles' members.
    looping = cut(now.filter("open").select("n", "up"))
    members = cut(looping.select(F.col("up").alias("n")).distinct())
    inside = edges.select(F.col(child).alias("last"), F.col(parent).alias("entry")).join(members.withColumnRenamed("n", "last"), "last").join(members.withColumnRenamed("n", "entry"), "entry", "left_semi")
    tails = edges.select(F.col(child).alias("n"), F.col(parent).alias("p")).join(looping.select("n"), "n", "left_semi").join(members, "n", "left_anti")
    entries = roots(tails, "n", "p").select("n", F.col("root").alias("entry")) if not tails.isEmpty() else members.select("n", F.col("n").alias("entry")).limit(0)
    entries = entries.union(members.select("n", F.col("n").alias("entry")))
    return done.union(entries.join(inside, "entry").select(F.col("n").alias(child), F.col("last").alias("root"), F.lit(-1).cast("long").alias("depth")))


def forward_fill(lines: DataFrame, order: str, values: dict[str, Column], within: list[str]) -> DataFrame:
    """Carries each value down to the lines after it, in each file: what an indented listing means."""
    w = Window.partitionBy(*within).orderBy(order).rowsBetween(Window.unboundedPreceding, 0)
    return lines.withColumns({name: F.last(value, ignorenulls=True).over(w) for name, value in values.items()})


def score_band(score: Column, high: float, medium: float) -> Column:
    return F.when(score >= high, "high").when(score >= medium, "medium").otherwise("low")


def clamp(score: Column, low: float = 0.0, high: float = 0.999) -> Column:
    return F.greatest(F.lit(low), F.least(F.lit(high), score))
