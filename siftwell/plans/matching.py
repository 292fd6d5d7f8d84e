"""Queries on names, identifiers, matching and resolution, each with its SQL twin."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .. import constants as C
from ..functions import similarity as sim
from ..functions import text as T
from ..operators import resolve as R
from ..operators import select as S
from ..operators import structure as ST


def _t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


CATEGORIES = [("Metal", "(bolt|gear|wire)"), ("Shape", "(ring|plate|disk)"), ("Device", "(gizmo|widget|gadget)")]
TAGS = [("warm", ["hot", "red"]), ("cold", ["cold", "blue"]), ("tiny", ["small", "mini"])]


def name_variants(spark, d):
    names = _t(spark, d, "part").select("p_name").union(_t(spark, d, "supplier").select("s_name")).union(_t(spark, d, "part").select(F.concat("p_brand", F.lit(" trans-Glasses' "), "p_type", F.lit(" berries"))))
    v = T.variants(F.col("p_name"))
    return names.distinct().select(F.col("p_name").alias("name"), *[v[n].alias(n) for n in T.VARIANTS])


def formula_key(spark, d):
    raw = F.concat("p_type", F.lit(" h2 "), "p_size", F.lit("\to"))
    return _t(spark, d, "part").select("p_partkey", T.formula_key(raw).alias("formula"))


def id_normalise(spark, d):
    raw = F.when(F.col("page_id") % 3 == 0, F.concat(F.lit("chebi:"), "page_id")).when(F.col("page_id") % 3 == 1, F.concat(F.lit(" "), "page_id")).otherwise(F.concat(F.lit("x"), "page_id"))
    return _t(spark, d, "pages").select("page_id", T.prefixed_id(raw, "CHEBI").alias("chebi_id"))


def multi_split(spark, d):
    raw = F.concat_ws(";", "p_name", F.lit(" "), "p_brand", F.concat("p_type", F.lit("|"), "p_size", F.lit(" * ")))
    values = T.split_multi(raw)
    return _t(spark, d, "part").select("p_partkey", F.size(values).cast("long").alias("n_values"), T.join_sorted(values).alias("joined"))


def regex_category(spark, d):
    return _t(spark, d, "part").select("p_partkey", T.first_category(F.col("p_name"), CATEGORIES).alias("category"))


def keyword_tags(spark, d):
    return _t(spark, d, "part").select("p_partkey", F.array_join(T.keyword_tags(F.col("p_name"), TAGS), ";").alias("tags"))


def contains_flag(spark, d):
    return _t(spark, d, "documents").select("doc_id", T.contains_any(F.col("text"), ["amp", "tion", "sch"]).alias("flag"))


def good_synonyms(spark, d):
    names = F.when(F.col("c_custkey") % 4 == 0, F.concat(F.lit("50-"), F.lpad(F.pmod("c_custkey", F.lit(90)).cast("string"), 2, "0"), F.lit("-7"))).when(F.col("c_custkey") % 4 == 1, F.concat(F.lit("CHEBI:"), "c_custkey")).when(F.col("c_custkey") % 4 == 2, "c_name").otherwise("c_mktsegment")
    return _t(spark, d, "customer").select("c_custkey", T.good_synonym(names).alias("good"))


def element_counts(spark, d):
    formula = F.concat(F.lit("C"), "p_size", F.lit("H"), F.col("p_size") * 2, F.lit("ClO"))
    counts = T.element_counts(formula)
    return _t(spark, d, "part").select("p_partkey", *[F.coalesce(counts[e], F.lit(0)).cast("long").alias(f"n_{e.lower()}") for e in ("C", "H", "Cl", "O", "N")])


def alias_dedupe(spark, d):
    c = _t(spark, d, "customer").select(F.col("c_nationkey").alias("entity"), F.col("c_mktsegment").alias("form"), F.col("c_name").alias("raw_name"), F.lit(0.07).alias("weight"))
    s = _t(spark, d, "supplier").select(F.col("s_nationkey").alias("entity"), F.lit("MACHINERY").alias("form"), F.col("s_name").alias("raw_name"), F.lit(0.08).alias("weight"))
    return S.dedupe_aliases(c.union(s), "entity", "form", "weight", ["raw_name"])


def preferred_record(spark, d):
    line = _t(spark, d, "lineitem")
    sizes = line.groupBy("l_suppkey").agg(F.count_distinct("l_partkey").alias("n_parts"))
    matches = _t(spark, d, "supplier").select("s_nationkey", F.col("s_suppkey").alias("l_suppkey"))
    return R.preferred(matches, "s_nationkey", "l_suppkey", sizes, "n_parts").select("s_nationkey", "l_suppkey", "n_parts")


def tier_cascade(spark, d):
    part, supplier = _t(spark, d, "part"), _t(spark, d, "supplier")
    parts = lambda rows, key: rows.select("p_partkey", key.cast("long").alias("key"))
    by_key, by_nation = (supplier.select("s_suppkey", F.col(c).cast("long").alias("key")) for c in ("s_suppkey", "s_nationkey"))
    tiers = [
        ("direct", 1.0, parts(part.filter("p_size < 10"), F.col("p_partkey")), by_key),
        ("size", 0.95, parts(part.filter("p_size < 20"), F.col("p_size")), by_nation),
        ("fallback", 0.85, parts(part, F.col("p_partkey") % 97), by_key),
    ]
    return R.keyed_cascade(tiers, "p_partkey", "s_suppkey")


def inverted_index_join(spark, d):
    index = R.name_index(_t(spark, d, "part").select("p_partkey", "p_name"), "p_partkey", "p_name")
    return index.groupBy("variant", "key").agg(F.count("*").alias("n_entities"), F.min("p_partkey").alias("first_entity"))


def ambiguity_cap(spark, d):
    names = _t(spark, d, "part").select("p_partkey", F.concat_ws(" ", "p_name", "p_brand").alias("n"))
    index = R.name_index(names, "p_partkey", "n").filter("variant = 'exact'")
    return R.unambiguous(index, "p_partkey").select("p_partkey", "key")


def anti_join_unmatched(spark, d):
    orders = _t(spark, d, "orders").select("o_custkey").distinct()
    return _t(spark, d, "customer").join(orders, F.col("c_custkey") == F.col("o_custkey"), "left_anti").select("c_custkey", "c_name")


def name_resolution_first_variant(spark, d):
    part = _t(spark, d, "part")
    index = R.name_index(part.select("p_partkey", F.concat_ws(" ", "p_name", "p_type").alias("n")), "p_partkey", "n")
    asked = part.select(F.when(F.col("p_partkey") % 2 == 0, F.concat(F.lit("cis-"), F.upper("p_name"), F.lit(" "), "p_type")).otherwise(F.concat(F.replace("p_name", F.lit(" "), F.lit("")), "p_type")).alias("query"))
    found = R.resolve_names(asked, "query", index, "p_partkey")
    return found.groupBy("query", "variant").agg(F.count("*").alias("n_hits"), F.min("p_partkey").alias("first_hit"))


def edit_distance_join(spark, d):
    names = _t(spark, d, "part").select("p_name").distinct()
    pairs = R.fuzzy_join(names.withColumnRenamed("p_name", "a"), "a", names.withColumnRenamed("p_name", "b"), "b")
    return pairs.filter("a < b").select("a", "b", F.col("distance").cast("int").alias("distance"))


def dice_match(spark, d):
    docs = _t(spark, d, "documents").select("doc_id", "text")
    return R.token_dice_join(docs, "doc_id", T.tokens(F.col("text")), _t(spark, d, "benchmark"), "item_id", T.tokens(F.col("text")), 0.6).withColumn("dice", F.round("dice", 6))


def jaccard_overlap(spark, d):
    line = _t(spark, d, "lineitem").select("l_suppkey", "l_partkey")
    brand = _t(spark, d, "part").select("p_brand", F.col("p_partkey").alias("l_partkey"))
    rows = R.shared_members(line, "l_suppkey", brand, "p_brand", "l_partkey")
    return rows.select("l_suppkey", "p_brand", "n_common", "n_a", "n_b", F.round("jaccard", 6).alias("jaccard"), F.round("overlap", 6).alias("overlap"))


def relational_division(spark, d):
    line = _t(spark, d, "lineitem").join(_t(spark, d, "part"), F.col("l_partkey") == F.col("p_partkey"))
    return R.division(line, "l_suppkey", "p_brand", _t(spark, d, "part"))


def root_ancestor(spark, d):
    conv = _t(spark, d, "conversations").filter("turn > 0")
    node = F.col("conv_id") * 1000 + F.col("turn")
    return R.roots(conv.select(node.alias("child"), (node - 1).alias("parent")), "child", "parent").withColumn("depth", F.col("depth").cast("long"))


def _fingerprints(spark, d):
    """vec_id and fp: a bit for each component, set if it is above 0, in words of 32 bits."""
    words = F.sequence(F.lit(0), F.greatest(F.lit(0), F.ceil(F.size("embedding") / 32).cast("int") - 1))
    bit = lambda x, i: F.when(x > 0, F.pow(F.lit(2.0), i % 32).cast("long")).otherwise(F.lit(0).cast("long"))
    word = lambda w: F.aggregate(F.slice(F.transform("embedding", bit), w * 32 + 1, F.lit(32)), F.lit(0).cast("long"), lambda a, x: a + x)
    return _t(spark, d, "embeddings").select("vec_id", F.transform(words, word).alias("fp"))


def tanimoto_topk(spark, d):
    bits = _fingerprints(spark, d)
    found = ST.nearest(bits.filter("vec_id % 50 = 0"), bits, "vec_id", "fp", 5, 0.0)
    return found.select("query_id", F.col("record_id").alias("vec_id"), F.round("similarity", 6).alias("tanimoto"), F.col("rank").cast("long").alias("rank"))


def pairwise_similarity_stats(spark, d):
    """Sets of eight neighbouring vectors."""
    bits = _fingerprints(spark, d)
    members = bits.select(F.floor(F.col("vec_id") / 8).alias("set_id"), F.col("vec_id").alias("member"))
    got = ST.pairwise_similarity(members, bits.withColumnRenamed("vec_id", "member"), ["set_id"])
    return got.select("set_id", "n_pairs", *[F.round(c, 6).alias(c) for c in ("mean", "most", "least")])


def structure_match(spark, d):
    """All vectors as compounds and as records; sixteen neighbours share a formula as compounds, the next sixteen as records."""
    bits = _fingerprints(spark, d)
    block = F.floor(F.col("vec_id") / 16)
    left = bits.select(F.col("vec_id").alias("compound_id"), block.cast("string").alias("formula_key"), "fp")
    right = bits.select(F.col("vec_id").alias("record_id"), (block - 1).cast("string").alias("formula_key"), "fp")
    got = ST.best_of_formula(left, right, least=0.45)
    return got.select("compound_id", "record_id", F.round("similarity", 6).alias("similarity"))


#: Words that the true patterns, ids and keywords meet, dealt out to parts by their number.
WORDS = ["biosynthesis", "degradation of camphor", "flavonoid signal", "membrane transport", "auxin salvage cycle", "lipid oxidative stress", "seed development", "methylation", "L-Ala indole", "NAD fixation", "sugar", "plain"]


def _named(spark, d):
    word = F.element_at(F.array(*map(F.lit, WORDS)), (F.col("p_partkey") % len(WORDS) + 1).cast("int"))
    return _t(spark, d, "part").select("p_partkey", F.concat_ws(" ", "p_name", word).alias("name"), word.alias("word"), "p_size")


def _named_sql() -> str:
    listed = ", ".join(f"'{w}'" for w in WORDS)
    return f"SELECT p_partkey, p_name || ' ' || [{listed}][p_partkey % {len(WORDS)} + 1] AS name, [{listed}][p_partkey % {len(WORDS)} + 1] AS word, p_size FROM part"


def pathway_category(spark, d):
    ids = F.element_at(F.array(*map(F.lit, (*C.COFACTOR_IDS, "X"))), (F.col("p_size") % 18 + 1).cast("int"))
    return _named(spark, d).select("p_partkey", T.first_category(F.col("name")).alias("category"), T.cofactor_like(ids, F.col("word")).alias("cofactor_like"))


def compound_classes(spark, d):
    classes = T.semantic_classes(F.col("name"), F.col("word"))
    return _named(spark, d).select("p_partkey", F.array_join(classes, ";").alias("classes"), F.round(T.semantic_consistency(classes, F.concat_ws(" ", "word", F.lit("sterol amino"))), 6).alias("consistency"))


def plant_context(spark, d):
    l2 = F.element_at(F.array(*map(F.lit, (*C.PRIMARY_BRITE_KEYWORDS, *C.SECONDARY_BRITE_KEYWORDS, "Other"))), (F.col("p_size") % 10 + 1).cast("int"))
    tags = T.plant_context_tags(F.when(F.col("p_partkey") % 3 > 0, "Metabolism").otherwise("Cellular"), l2, F.lit(""), F.col("word"), F.col("p_partkey") % 2 == 0)
    return _named(spark, d).select("p_partkey", F.array_join(tags, ";").alias("tags"))


def ec_extract(spark, d):
    raw = F.concat(F.lit("ec-1."), "p_size", F.lit(".3.- and 2.7, 4.1.1.1."), "p_size", F.lit(" EC-2.7"))
    return _t(spark, d, "part").select("p_partkey", F.array_join(T.ec_numbers(raw), ";").alias("ec"))


def token_edit_match(spark, d):
    """Part names within one token of another."""
    names = _t(spark, d, "part").select(F.col("p_name").alias("name")).distinct()
    index = names.union(names.select(F.concat(F.col("name"), F.lit(" hydrate"))))
    return R.token_edit_join(index, "name", names, "name").select(F.col("left").alias("indexed"), F.col("right").alias("query"))


def difflib_ratio(spark, d):
    names = _t(spark, d, "part").select("p_name").distinct()
    pairs = R.length_pairs(names, "p_name", names.withColumnRenamed("p_name", "other"), "other")
    return pairs.select("p_name", "other", F.round(sim.sequence_ratio(F.col("p_name"), F.col("other")), 6).alias("ratio"))


def nfkd_normalise(spark, d):
    return _t(spark, d, "documents").select("doc_id", F.md5(T.normalize_name(F.col("text"))).alias("name_md5"), F.md5(T.fold_ascii(F.col("text"))).alias("folded_md5"))


QUERIES = {f.__name__: f for f in (
    name_variants, formula_key, id_normalise, multi_split, regex_category, keyword_tags, contains_flag, good_synonyms, element_counts, alias_dedupe, preferred_record, tier_cascade, inverted_index_join, ambiguity_cap,
    anti_join_unmatched, name_resolution_first_variant, edit_distance_join, dice_match, jaccard_overlap, relational_division, root_ancestor, tanimoto_topk, difflib_ratio, nfkd_normalise,
    pairwise_similarity_stats, structure_match, pathway_category, compound_classes, plant_context, ec_extract, token_edit_match,
)}


_SINGULAR = """array_to_string(list_transform(string_split(exact, ' '), lambda t: CASE WHEN length(t) > 4 AND t LIKE '%ies' THEN substr(t, 1, length(t) - 3) || 'y'
  WHEN length(t) <= 4 OR regexp_matches(t, '(sses|osis|is|us|ss)$') OR t NOT LIKE '%s' THEN t ELSE substr(t, 1, length(t) - 1) END), ' ')"""


def _all_variants(source: str, keep: str) -> str:
    """keep, exact, compact, singular, stereo_stripped from a query with columns keep and name (plain ASCII)."""
    return f"""SELECT {keep}, exact, replace(exact, ' ', '') AS compact, singular, trim(regexp_replace(singular, '^(?:(?:{'|'.join(C.LEADING_STEREO_TOKENS)})(?: |$))+', '')) AS stereo_stripped
      FROM (SELECT *, {_SINGULAR} AS singular FROM (SELECT *, trim(regexp_replace(replace(lower(name), chr(39), ''), '[^a-z0-9]+', ' ', 'g')) AS exact FROM ({source})))"""


def _index(source: str, entity: str) -> str:
    v = _all_variants(source, entity)
    return " UNION ".join(f"SELECT {entity}, {i} AS variant_rank, '{n}' AS variant, {n} AS key FROM ({v}) WHERE {n} <> ''" for i, n in enumerate(T.VARIANTS))


def _any(where: str, words) -> str:
    return "(" + " OR ".join(f"contains({where}, '{w}')" for w in words) + ")"


_SYNONYM = "CASE c_custkey % 4 WHEN 0 THEN '50-' || lpad(CAST(c_custkey % 90 AS VARCHAR), 2, '0') || '-7' WHEN 1 THEN 'CHEBI:' || c_custkey WHEN 2 THEN c_name ELSE c_mktsegment END"
_BITS = "SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x > 0 AS INTEGER)) AS f FROM embeddings"
_TANIMOTO = "list_sum(list_transform(list_zip(a.f, b.f), lambda z: z[1] * z[2])) AS i, list_sum(a.f) + list_sum(b.f) AS s"
_CLASSES = "list_filter([" + ", ".join(f"CASE WHEN regexp_matches(name || ' ' || word, '(?i){p}') THEN '{c}' END" for c, p in C.SEMANTIC_CLASS_PATTERNS.items()) + "], lambda x: x IS NOT NULL)"
_CONSISTENT = " + ".join(f"CASE WHEN list_contains(classes, '{c}') AND list_has_any(w, [{', '.join(repr(k) for k in ks)}]) THEN 1 ELSE 0 END" for c, ks in C.CLASS_KEYWORDS.items())
_BRITE = ", ".join(f"'{k}'" for k in (*C.PRIMARY_BRITE_KEYWORDS, *C.SECONDARY_BRITE_KEYWORDS, "other"))
_TEXT = "l1 || ' ' || l2 || '  ' || name"
_TAGS = "list_filter([" + ", ".join([
    f"CASE WHEN l1 = 'metabolism' AND {_any('l2', C.PRIMARY_BRITE_KEYWORDS)} THEN 'primary_metabolism' END",
    f"CASE WHEN l1 = 'metabolism' AND ({_any('l2', C.SECONDARY_BRITE_KEYWORDS)} OR {_any(_TEXT, C.SECONDARY_NAME_KEYWORDS)}) THEN 'secondary_metabolism' END",
    *[f"CASE WHEN {_any(_TEXT, words)} THEN '{tag}' END" for tag, words in (("hormone_related", C.HORMONE_KEYWORDS), ("stress_related", C.STRESS_KEYWORDS), ("development_related", C.DEVELOPMENT_KEYWORDS), ("transport_related", C.TRANSPORT_KEYWORDS))],
]) + "], lambda x: x IS NOT NULL)"

_SPLIT = "list_filter(list_transform(regexp_split_to_array(p_name || '; ;' || p_brand || ';' || p_type || '|' || p_size || ' * ', '[;|*]'), lambda x: trim(x)), lambda x: x <> '')"

SQL = {
    "name_variants": _all_variants("SELECT DISTINCT name FROM (SELECT p_name AS name FROM part UNION ALL SELECT s_name FROM supplier UNION ALL SELECT p_brand || ' trans-Glasses'' ' || p_type || ' berries' FROM part)", "name"),
    "formula_key": "SELECT p_partkey, upper(regexp_replace(p_type || ' h2 ' || p_size || chr(9) || 'o', '\\s+', '', 'g')) AS formula FROM part",
    "id_normalise": "SELECT page_id, CASE page_id % 3 WHEN 2 THEN 'x' || page_id ELSE 'CHEBI:' || page_id END AS chebi_id FROM pages",
    "multi_split": f"SELECT p_partkey, CAST(len({_SPLIT}) AS BIGINT) AS n_values, array_to_string(list_sort(list_distinct({_SPLIT})), ';') AS joined FROM part",
    "regex_category": "SELECT p_partkey, CASE " + " ".join(f"WHEN regexp_matches(p_name, '(?i){p}') THEN '{n}'" for n, p in CATEGORIES) + " ELSE 'Other' END AS category FROM part",
    "keyword_tags": "SELECT p_partkey, concat_ws(';', " + ", ".join("CASE WHEN " + " OR ".join(f"contains(lower(p_name), '{w}')" for w in ws) + f" THEN '{tag}' END" for tag, ws in TAGS) + ") AS tags FROM part",
    "contains_flag": "SELECT doc_id, contains(lower(text), 'amp') OR contains(lower(text), 'tion') OR contains(lower(text), 'sch') AS flag FROM documents",
    "good_synonyms": f"""SELECT c_custkey, length(t) BETWEEN 3 AND 120 AND NOT starts_with(t, 'InChI=') AND NOT starts_with(t, 'InChIKey=') AND NOT regexp_matches(t, '^\\d{{2,7}}-\\d{{2}}-\\d$')
        AND NOT regexp_matches(t, '(?i)^(CID|SID|DTXSID|DTXCID|CHEBI|HMDB|LM)[A-Z0-9:\\-]+$') AND NOT regexp_matches(t, '^[0-9\\W_]+$')
        AND NOT (NOT contains(t, ' ') AND len(regexp_extract_all(t, '[0-9]')) >= 3 AND NOT regexp_matches(t, '[a-z]')) AS good FROM (SELECT c_custkey, trim({_SYNONYM}) AS t FROM customer)""",
    "element_counts": "SELECT p_partkey, CAST(p_size AS BIGINT) AS n_c, CAST(p_size * 2 AS BIGINT) AS n_h, CAST(1 AS BIGINT) AS n_cl, CAST(1 AS BIGINT) AS n_o, CAST(0 AS BIGINT) AS n_n FROM part",
    "alias_dedupe": """SELECT entity, form, raw_name, weight FROM (SELECT *, row_number() OVER (PARTITION BY entity, form ORDER BY weight DESC, raw_name) AS r FROM
        (SELECT c_nationkey AS entity, c_mktsegment AS form, c_name AS raw_name, CAST(0.07 AS DOUBLE) AS weight FROM customer UNION ALL SELECT s_nationkey, 'MACHINERY', s_name, CAST(0.08 AS DOUBLE) FROM supplier)) WHERE r = 1""",
    "preferred_record": """SELECT s_nationkey, l_suppkey, n_parts FROM (SELECT s_nationkey, s_suppkey AS l_suppkey, n_parts, row_number() OVER (PARTITION BY s_nationkey ORDER BY n_parts DESC NULLS LAST, s_suppkey) AS r
        FROM supplier LEFT JOIN (SELECT l_suppkey, count(DISTINCT l_partkey) AS n_parts FROM lineitem GROUP BY 1) ON l_suppkey = s_suppkey) WHERE r = 1""",
    "tier_cascade": """WITH t AS (SELECT p_partkey, s_suppkey, CAST(1 AS INTEGER) AS tier, 'direct' AS method, CAST(1.0 AS DOUBLE) AS score FROM part JOIN supplier ON p_partkey = s_suppkey WHERE p_size < 10
        UNION SELECT p_partkey, s_suppkey, 2, 'size', CAST(0.95 AS DOUBLE) FROM part JOIN supplier ON p_size = s_nationkey WHERE p_size < 20
        UNION SELECT p_partkey, s_suppkey, 3, 'fallback', CAST(0.85 AS DOUBLE) FROM part JOIN supplier ON p_partkey % 97 = s_suppkey)
        SELECT * FROM t WHERE tier = (SELECT min(tier) FROM t u WHERE u.p_partkey = t.p_partkey)""",
    "inverted_index_join": f"SELECT variant, key, count(*) AS n_entities, min(p_partkey) AS first_entity FROM ({_index('SELECT p_partkey, p_name AS name FROM part', 'p_partkey')}) GROUP BY variant, key",
    "ambiguity_cap": f"""WITH i AS (SELECT * FROM ({_index("SELECT p_partkey, p_name || ' ' || p_brand AS name FROM part", 'p_partkey')}) WHERE variant = 'exact')
        SELECT p_partkey, key FROM i WHERE key IN (SELECT key FROM i GROUP BY key HAVING count(DISTINCT p_partkey) <= 5)""",
    "anti_join_unmatched": "SELECT c_custkey, c_name FROM customer WHERE NOT EXISTS (SELECT 1 FROM orders WHERE o_custkey = c_custkey)",
    "name_resolution_first_variant": f"""WITH i AS ({_index("SELECT p_partkey, p_name || ' ' || p_type AS name FROM part", 'p_partkey')}),
        q AS ({_index("SELECT *, query AS name FROM (SELECT DISTINCT CASE WHEN p_partkey % 2 = 0 THEN 'cis-' || upper(p_name) || ' ' || p_type ELSE replace(p_name, ' ', '') || p_type END AS query FROM part)", 'query')}),
        h AS (SELECT DISTINCT query, variant_rank, variant, i2.p_partkey FROM q JOIN (SELECT DISTINCT key, p_partkey FROM i) i2 USING (key))
        SELECT query, variant, count(*) AS n_hits, min(p_partkey) AS first_hit FROM h WHERE variant_rank = (SELECT min(variant_rank) FROM h x WHERE x.query = h.query) GROUP BY query, variant""",
    "edit_distance_join": """WITH n AS (SELECT DISTINCT p_name FROM part) SELECT a.p_name AS a, b.p_name AS b, CAST(levenshtein(a.p_name, b.p_name) AS INTEGER) AS distance FROM n a, n b
        WHERE a.p_name < b.p_name AND levenshtein(a.p_name, b.p_name) <= 2 AND length(a.p_name) >= 6 AND length(b.p_name) >= 6""",
    "dice_match": """WITH d AS (SELECT DISTINCT doc_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS t FROM documents), b AS (SELECT DISTINCT item_id, unnest(regexp_extract_all(lower(text), '[a-z0-9]+')) AS t FROM benchmark)
        SELECT doc_id, item_id, round(2.0 * c / (na + nb), 6) AS dice FROM (SELECT doc_id, item_id, count(*) AS c FROM d JOIN b USING (t) GROUP BY 1, 2)
        JOIN (SELECT doc_id, count(*) AS na FROM d GROUP BY 1) USING (doc_id) JOIN (SELECT item_id, count(*) AS nb FROM b GROUP BY 1) USING (item_id) WHERE 2.0 * c / (na + nb) >= 0.6""",
    "jaccard_overlap": """WITH a AS (SELECT DISTINCT l_suppkey, l_partkey FROM lineitem), b AS (SELECT p_brand, p_partkey AS l_partkey FROM part)
        SELECT l_suppkey, p_brand, n_common, n_a, n_b, round(n_common / CAST(n_a + n_b - n_common AS DOUBLE), 6) AS jaccard, round(n_common / CAST(least(n_a, n_b) AS DOUBLE), 6) AS overlap
        FROM (SELECT l_suppkey, p_brand, count(*) AS n_common FROM a JOIN b USING (l_partkey) GROUP BY 1, 2) JOIN (SELECT l_suppkey, count(*) AS n_a FROM a GROUP BY 1) USING (l_suppkey) JOIN (SELECT p_brand, count(*) AS n_b FROM b GROUP BY 1) USING (p_brand)""",
    "relational_division": "SELECT l_suppkey FROM lineitem JOIN part ON l_partkey = p_partkey GROUP BY l_suppkey HAVING count(DISTINCT p_brand) = (SELECT count(DISTINCT p_brand) FROM part)",
    "root_ancestor": """WITH RECURSIVE e AS (SELECT conv_id * 1000 + turn AS child, conv_id * 1000 + turn - 1 AS parent FROM conversations WHERE turn > 0),
        w(child, up, depth) AS (SELECT child, parent, CAST(1 AS BIGINT) FROM e UNION ALL SELECT w.child, e.parent, w.depth + 1 FROM w JOIN e ON w.up = e.child)
        SELECT child, max_by(up, depth) AS root, max(depth) AS depth FROM w GROUP BY child""",
    "tanimoto_topk": f"""WITH x AS ({_BITS}), p AS (SELECT a.vec_id AS query_id, b.vec_id, {_TANIMOTO} FROM x a, x b WHERE a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
        t AS (SELECT query_id, vec_id, CASE WHEN s - i > 0 THEN i / CAST(s - i AS DOUBLE) ELSE 0 END AS tanimoto FROM p)
        SELECT query_id, vec_id, round(tanimoto, 6) AS tanimoto, rank FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY tanimoto DESC, vec_id) AS rank FROM t) WHERE rank <= 5""",
    "pairwise_similarity_stats": f"""WITH x AS ({_BITS}), p AS (SELECT CAST(floor(a.vec_id / 8) AS BIGINT) AS set_id, {_TANIMOTO} FROM x a JOIN x b ON floor(a.vec_id / 8) = floor(b.vec_id / 8) AND a.vec_id < b.vec_id),
        t AS (SELECT set_id, CASE WHEN s - i > 0 THEN i / CAST(s - i AS DOUBLE) ELSE 0 END AS v FROM p)
        SELECT set_id, count(*) AS n_pairs, round(avg(v), 6) AS mean, round(max(v), 6) AS most, round(min(v), 6) AS least FROM t GROUP BY set_id""",
    "structure_match": f"""WITH x AS ({_BITS}), p AS (SELECT a.vec_id AS compound_id, b.vec_id AS record_id, {_TANIMOTO} FROM x a JOIN x b ON floor(b.vec_id / 16) = floor(a.vec_id / 16) + 1),
        t AS (SELECT *, CASE WHEN s - i > 0 THEN i / CAST(s - i AS DOUBLE) ELSE 0 END AS v FROM p)
        SELECT compound_id, record_id, round(v, 6) AS similarity FROM (SELECT *, row_number() OVER (PARTITION BY compound_id ORDER BY v DESC, record_id) AS r FROM t WHERE v >= 0.45) WHERE r = 1""",
    "pathway_category": "SELECT p_partkey, CASE " + " ".join(f"WHEN regexp_matches(name, '(?i){p}') THEN '{n}'" for n, p in C.CATEGORY_PATTERNS) + f" ELSE 'Other' END AS category, p_size % 18 < 17 OR {_any('lower(word)', C.COFACTOR_NAME_TOKENS)} AS cofactor_like FROM ({_named_sql()})",
    "compound_classes": f"""SELECT p_partkey, array_to_string(classes, ';') AS classes, round(least(3.0, {_CONSISTENT}) / 3.0, 6) AS consistency
        FROM (SELECT p_partkey, {_CLASSES} AS classes, regexp_extract_all(lower(word || ' sterol amino'), '[a-z]+') AS w FROM ({_named_sql()}))""",
    "plant_context": f"""SELECT p_partkey, array_to_string(CASE WHEN len(tags) = 0 AND p_partkey % 2 = 0 AND l1 = 'metabolism' THEN ['primary_metabolism'] ELSE tags END, ';') AS tags
        FROM (SELECT *, {_TAGS} AS tags FROM (SELECT p_partkey, CASE WHEN p_partkey % 3 > 0 THEN 'metabolism' ELSE 'cellular' END AS l1, [{_BRITE}][p_size % 10 + 1] AS l2, lower(word) AS name FROM ({_named_sql()})))""",
    "ec_extract": "SELECT p_partkey, array_to_string(list_sort(list_distinct(['EC-1.' || p_size || '.3.-', 'EC-2.7', 'EC-4.1.1.1'])), ';') AS ec FROM part",
    "token_edit_match": """WITH n AS (SELECT DISTINCT p_name AS name FROM part), i AS (SELECT name FROM n UNION SELECT name || ' hydrate' FROM n),
        p AS (SELECT i.name AS indexed, n.name AS query, string_split(i.name, ' ') AS a, string_split(n.name, ' ') AS b FROM i, n)
        SELECT indexed, query FROM p WHERE indexed = query OR indexed = query || ' hydrate'
          OR (len(a) = len(b) AND len(list_filter(list_zip(a, b), lambda z: z[1] <> z[2])) = 1 AND len(a) > 1
              AND levenshtein(list_filter(list_zip(a, b), lambda z: z[1] <> z[2])[1][1], list_filter(list_zip(a, b), lambda z: z[1] <> z[2])[1][2]) <= 1)""",
}
