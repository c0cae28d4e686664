"""Deduplication, curation, joins, counts and orders over tables."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folioforge.sources.folders import new_folder

# fixed values: ordered domains
SERIES = ["mmwr", "mmnd", "mmrr", "mmss", "mmsu", "eid", "eid0", "eid1", "eid2", "eid3", "pcd"]
LEVELS = ["home", "series", "volume", "issue", "article"]
STRATA = ["mmwr_toc", "mmwr_art", "eid_toc", "eid_art", "pcd_toc", "pcd_art"]
COLLECTIONS = [
    "mmwr_toc_en", "mmrr_toc_en", "mmss_toc_en", "mmsu_toc_en", "mmwr_art_en", "mmrr_art_en", "mmss_art_en", "mmsu_art_en", "mmnd_art_en", "mmwr_art_es", "eid_toc_en",
    "eid0_art_en", "eid1_art_en", "eid2_art_en", "eid3_art_en", "pcd_toc_en", "pcd_toc_es", "pcd_art_en", "pcd_art_es", "pcd_art_fr", "pcd_art_zhs", "pcd_art_zht",
]
SCOPES = {"home": "", "series": "", "volume": "toc", "issue": "toc", "article": "art"}
CORPUS = [
    "url", "stratum", "collection", "series", "level", "lang", "dl_year_mo", "dl_vol_iss", "dl_date", "dl_page", "dl_art_num", "dateline", "base", "string", "link_canon",
    "mirror_path", "md_citation_doi", "title", "md_citation_categories", "dl_cat", "md_kwds", "md_desc", "md_citation_author",
]


def ordinal(column: Column, domain: list[str]) -> Column:
    """1 on in the domain's order, null outside it."""
    return F.nullif(F.array_position(F.array(*map(F.lit, domain)), column), F.lit(0))


def domain_order(column: Column, domain: list[str]) -> Column:
    return ordinal(column, domain).asc_nulls_last()


#: Ordered domains of the corpus' columns.
DOMAINS = {"stratum": STRATA, "collection": COLLECTIONS, "series": SERIES, "level": LEVELS}


def with_domains(df: DataFrame, domains: dict[str, list[str]] = DOMAINS) -> DataFrame:
    """df whose columns carry their ordered domains in the schema (J12): tables written as Parquet, and the corpus' CSV, keep them."""
    for c, d in domains.items():
        if c in df.columns:
            df = df.withMetadata(c, {**df.schema[c].metadata, "domain": d})
    return df


def domains_of(df: DataFrame) -> dict[str, list[str]]:
    """The ordered domains that a table's columns carry."""
    return {f.name: list(f.metadata["domain"]) for f in df.schema if f.metadata.get("domain")}


def sort_keys(df: DataFrame, columns: list[str], prefix: str = "_o") -> dict[str, Column]:
    """Columns that sort ascending as df's do: those with a domain by it, what is outside it and nulls last, others by value, nulls last."""
    domains, out = domains_of(df), {}
    for k, c in enumerate(columns):
        value = ordinal(F.col(c), domains[c]) if c in domains else F.col(c)
        out |= {f"{prefix}{k}n": value.isNull(), f"{prefix}{k}": value}
    return out


def sort_by(df: DataFrame, *columns: str) -> DataFrame:
    """df sorted by columns, as their domains say."""
    order = sort_keys(df, [*columns])
    return df.withColumns(order).orderBy(*order).drop(*order)


def places_by(df: DataFrame, columns: list[str], tie: str, name: str = "place") -> DataFrame:
    """df with each row's place in that order, ties by a unique column, over many partitions."""
    order = sort_keys(df, columns)
    return ranked(df.withColumns(order), [*order, tie], name).drop(*order)


def duplicates(df: DataFrame, key: Column, alias: str = "n") -> DataFrame:
    """All rows of keys that occur more than once (E1). Counts are pre-aggregated and joined back: no window over a hot key."""
    counted = df.withColumn("_key", key).groupBy("_key").agg(F.count("*").alias(alias)).where(F.col(alias) > 1)
    return df.withColumn("_key", key).join(counted, "_key").drop("_key")


def duplicates_by_column(df: DataFrame, columns: list[str], id_col: str) -> DataFrame:
    """(column, value, id, n) of all rows whose value of a column occurs more than once."""
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns)))
    long = df.select(F.col(id_col).alias("id"), pairs.alias("_p")).select("_p.column", "_p.value", "id").where("value is not null")
    counted = long.groupBy("column", "value").agg(F.count("*").alias("n")).where("n > 1")
    return long.join(counted, ["column", "value"])


def drop_rows(df: DataFrame, rules: DataFrame, on: list[str]) -> DataFrame:
    """Rows that no rule names."""
    return df.join(rules.select(*on).distinct(), on, "left_anti")


#: Blocks of a Bloom filter, each a bitmap of 4 kB: 16 MB at most are sent to tasks, however many keys there are.
BLOOM_BLOCKS, BLOOM_BITS, BLOOM_KEYS = 4096, 4, 2048
_BLOCK = 32_768


def bloom_filter(df: DataFrame, key: str, blocks: int) -> DataFrame:
    """(block, bits) of the keys: a hash picks a key's block, others BLOOM_BITS bits of it. Built by Spark's bitmap aggregates."""
    return df.select(*_bloom_places(F.col(key), blocks)).select("block", F.explode("places").alias("at")).groupBy("block").agg(F.bitmap_construct_agg("at").alias("bits"))


def _bloom_places(key: Column, blocks: int) -> tuple[Column, Column]:
    h = F.xxhash64(key)
    places = F.transform(F.sequence(F.lit(1), F.lit(BLOOM_BITS)), lambda i: F.pmod(F.xxhash64(h, i), F.lit(_BLOCK)))
    return F.pmod(h, F.lit(blocks)).alias("block"), places.alias("places")


def unseen(df: DataFrame, seen: DataFrame, key: str) -> DataFrame:
    """Rows of df whose key isn't among those of seen; null keys are never seen. A Bloom filter of bounded size over the seen
    keys lets most new rows pass without a join; only those that it may hold are compared with the keys themselves."""
    n = seen.count()
    blocks = max(1, min(BLOOM_BLOCKS, -(-n // BLOOM_KEYS)))
    kept = bloom_filter(seen.where(F.col(key).isNotNull()), key, blocks)
    block, places = _bloom_places(F.col(key), blocks)
    marked = df.withColumns({"_block": block, "_places": places}).join(F.broadcast(kept.select(F.col("block").alias("_block"), F.col("bits").alias("_bits"))), "_block", "left")
    # bit k of a bitmap is bit k % 8 of its byte k / 8
    byte = lambda k: F.conv(F.hex(F.substring("_bits", F.shiftright(k, 3).cast("int") + 1, 1)), 16, 10).cast("int")
    held = F.forall("_places", lambda k: (F.floor(byte(k) / F.pow(F.lit(2), k % 8)) % 2) == 1)
    maybe = F.col("_bits").isNotNull() & F.col(key).isNotNull() & held
    marked = marked.withColumn("_maybe", F.coalesce(maybe, F.lit(False))).drop("_block", "_places", "_bits")
    new = marked.where(~F.col("_maybe")).select(*df.columns)
    return new.unionByName(marked.where("_maybe").select(*df.columns).join(seen.select(key).distinct(), key, "left_anti").select(*df.columns))


def override(df: DataFrame, corrections: DataFrame, on: str, column: str, value: str = "value") -> DataFrame:
    """The column's value from corrections where they have the key."""
    fix = corrections.select(F.col(on), F.col(value).alias("_fix"))
    return df.join(fix, on, "left").withColumn(column, F.coalesce("_fix", column)).drop("_fix")


def lookup(df: DataFrame, key: str, table: DataFrame | None, name: str) -> DataFrame:
    """The value of a (key, value) table beside each row, null where it has none (H8). The join is Spark's choice, by the table's size."""
    if table is None:
        return df.withColumn(name, F.lit(None).cast("string"))
    return df.join(table.select(F.col("key").alias(key), F.col("value").alias(name)), key, "left")


def looked_up(df: DataFrame, store: DataFrame, key: str, value: str) -> DataFrame:
    """df with the store's value of its key (H9). A row without one ends the query with an error that names its key."""
    kept = store.select(F.col(key), F.col(value), F.lit(True).alias("_there"))
    missing = F.raise_error(F.concat(F.lit(f"no {value} of "), F.coalesce(F.col(key).cast("string"), F.lit("null"))))
    return df.join(kept, key, "left").withColumn(value, F.when(F.col("_there"), F.col(value)).otherwise(missing)).drop("_there")


def subset(df: DataFrame, column: str, patterns: list[str]) -> DataFrame:
    """Rows whose column matches one of the patterns."""
    return df.where(reduce(lambda a, b: a | b, (F.col(column).rlike(p) for p in patterns)))


def compared(a: DataFrame, b: DataFrame, on: str) -> DataFrame:
    """Keys of both sides with the columns of each, _x and _y (H5)."""
    x, y = (t.select(on, *(F.col(c).alias(c + end) for c in t.columns if c != on)) for t, end in ((a, "_x"), (b, "_y")))
    return x.join(y, on)


def drop_repeated_notices(links: DataFrame, notice: str, suffix: str) -> DataFrame:
    """Without empty texts, and without links whose text starts with a notice, whose url has a suffix, and whose path
    occurs more than once among all links (E5, E6)."""
    counts = links.groupBy("path").agg(F.count("*").alias("_n")).where("_n > 1")
    marked = links.join(counts, "path", "left")
    gone = F.col("string").startswith(notice) & F.col("url").endswith(suffix) & F.col("_n").isNotNull()
    return marked.where((F.col("string") != "") & ~F.coalesce(gone, F.lit(False))).select(*links.columns)


def merged(first: DataFrame, second: DataFrame, key: str) -> DataFrame:
    """Rows of both by key; where both have it, the second's."""
    return first.join(second.select(key), key, "left_anti").unionByName(second)


def greatest_counts(a: DataFrame, b: DataFrame, key: str, n: str) -> DataFrame:
    """The union of two counters: the greater count of each key."""
    return a.select(key, n).unionByName(b.select(key, n)).groupBy(key).agg(F.max(n).alias(n))


def union(*tables: DataFrame) -> DataFrame:
    """UNION ALL by name; missing columns are null."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), tables)


def crosstab(df: DataFrame, a: str, b: str) -> DataFrame:
    """Counts by both, by each, and in all; All stands for the margins."""
    out = df.cube(a, b).agg(F.count("*").alias("n"), F.grouping(a).alias("_a"), F.grouping(b).alias("_b"))
    return out.select(*(F.when(F.col(g) == 1, "All").otherwise(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c, g in ((a, "_a"), (b, "_b"))), "n")


def crosstabs(df: DataFrame, by: str, a: str, b: str) -> DataFrame:
    """The crosstab of each value of a column, one after another, by one scan."""
    sets = [[by, a, b], [by, a], [by, b], [by]]
    counts = df.groupingSets([[F.col(c) for c in x] for x in sets], by, a, b).agg(F.count("*").alias("n"), F.grouping(a).alias("_a"), F.grouping(b).alias("_b"))
    return counts.select(by, *(F.when(F.col(g) == 1, "All").otherwise(F.coalesce(F.col(c).cast("string"), F.lit(""))).alias(c) for c, g in ((a, "_a"), (b, "_b"))), "n")


#: Rows of a task of costly work by row, about: what a core does in some seconds to half a minute.
TASK_ROWS = 50_000


def spread(df: DataFrame) -> DataFrame:
    """A scan over all cores where it has fewer partitions than that, as a small file has, for costly work by row; where its
    partitions hold many short rows, over as many tasks as have TASK_ROWS each, so that no task grows with the table. Others
    come as they are, without a shuffle. For scans only: the plan of a query with shuffles would run, and rows are counted,
    for which files' footers are read."""
    cores, parts = df.sparkSession.sparkContext.defaultParallelism, df._jdf.queryExecution().toRdd().getNumPartitions()
    tasks = max(cores, -(-df.count() // TASK_ROWS))
    return df.repartition(tasks) if parts < cores or 2 * parts < tasks else df


def grouping_counts(df: DataFrame, sets: list[list[str]]) -> DataFrame:
    """Counts by each set of columns, one table for all, by one scan (B7, K1): `_set` is its columns with commas between; columns outside it are null."""
    every = list(dict.fromkeys(c for columns in sets for c in columns))
    counts = df.groupingSets([[F.col(c) for c in columns] for columns in sets], *every).agg(F.count("*").alias("n"), F.grouping_id(*every).alias("_id"))
    # bit k from the left of a grouping's id is set where column k isn't in it
    name = F.coalesce(*(F.when(F.col("_id") == sum(1 << (len(every) - 1 - k) for k, c in enumerate(every) if c not in columns), F.lit(",".join(columns))) for columns in sets))
    return counts.select(name.alias("_set"), *(F.col(c).cast("string") for c in every), "n")


def value_counts(df: DataFrame, column: str, domain: list[str]) -> DataFrame:
    """Counts in the domain's order, zeros too (K2)."""
    all_ = df.sparkSession.createDataFrame([(i, v) for i, v in enumerate(domain, 1)], f"ord int, {column} string")
    counts = df.groupBy(column).agg(F.count("*").alias("n"))
    return all_.join(counts, column, "left").select("ord", column, F.coalesce("n", F.lit(0)).alias("n"))


def collection(series: Column, level: Column, lang: Column) -> Column:
    """series_scope_lang; Spanish articles of the weeklies are one collection."""
    scope = F.element_at(F.create_map(*[F.lit(x) for kv in SCOPES.items() for x in kv]), level)
    return F.when(series.startswith("mm") & (lang == "es"), "mmwr_art_es").otherwise(F.concat_ws("_", series, scope, lang))


def corpus(links: DataFrame, datelines: DataFrame, metadata: DataFrame, levels: list[str]) -> DataFrame:
    """links, datelines and head metadata by path; filtered before the joins (H1)."""
    kept = links.where(F.col("level").isin(levels))
    return kept.join(datelines.withColumnRenamed("path", "mirror_path"), "mirror_path").join(metadata.withColumnRenamed("path", "mirror_path"), "mirror_path")


#: The columns by which the corpus is sorted; strings by code point, nulls last.
CORPUS_KEYS = ["collection", "series", "level", "lang", "dl_vol_iss", "dl_date", "dl_page", "dl_art_num"]


def corpus_places(df: DataFrame, tie: str, name: str = "place") -> DataFrame:
    """df with each row's place in the corpus' order (K10), ties by a unique column. Columns that carry no domain have the corpus' own."""
    return places_by(with_domains(df, DOMAINS | domains_of(df)), CORPUS_KEYS, tie, name)


def sorted_corpus(df: DataFrame) -> DataFrame:
    return sort_by(with_domains(df, DOMAINS | domains_of(df)), *CORPUS_KEYS)


def stored(df: DataFrame) -> DataFrame:
    """df as written to the shared folder, that of spark.checkpoint.dir: computed once, there when executors are lost, gone when the driver ends."""
    path = new_folder(df.sparkSession, "stored")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def ranked(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """1 on in the order of keys, over many partitions: the rows before each partition are counted first."""
    n = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = stored(df.repartitionByRange(n, *keys).sortWithinPartitions(*keys).withColumn("_m", F.monotonically_increasing_id()).withColumn("_p", F.shiftright("_m", 33)))
    counts = rows.groupBy("_p").agg(F.count("*").alias("_n"))
    ahead = counts.withColumn("_a", F.coalesce(F.sum("_n").over(Window.orderBy("_p").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).select("_p", "_a")  # a row a partition
    return rows.join(F.broadcast(ahead), "_p").withColumn(name, F.col("_a") + F.col("_m") - F.shiftleft(F.col("_p"), 33) + 1).drop("_m", "_p", "_a")


def outside_domains(df: DataFrame) -> DataFrame:
    """(column, value, n) of values that the domains of their columns lack (L8), those that the columns carry or else the corpus'; such values read back as null."""
    domains = domains_of(df) or {c: d for c, d in DOMAINS.items() if c in df.columns}
    pairs = F.explode(F.array(*(F.struct(F.lit(c).alias("column"), F.when(~F.col(c).isin(d), F.col(c)).alias("value")) for c, d in domains.items())))
    return df.select(pairs.alias("_p")).select("_p.*").where("value is not null and value <> ''").groupBy("column", "value").agg(F.count("*").alias("n"))


def projected(df: DataFrame) -> DataFrame:
    """The corpus' 23 columns, absent ones empty."""
    return df.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) if c in df.columns else F.lit("").alias(c) for c in CORPUS))


def translations(docs: DataFrame, english: DataFrame, columns: list[str]) -> DataFrame:
    """Translations take what the English page's dateline says (H6). docs: path, path_en; english: path and columns."""
    return docs.join(english.select(F.col("path").alias("path_en"), *columns), "path_en", "left")


def key_differences(a: DataFrame, b: DataFrame, key: str) -> DataFrame:
    """Keys of one side only, with the side."""
    left, right = a.select(key).distinct().withColumn("_a", F.lit(1)), b.select(key).distinct().withColumn("_b", F.lit(1))
    return left.join(right, key, "full").where("_a is null or _b is null").select(key, F.when(F.col("_b").isNull(), "left").otherwise("right").alias("side"))


def consistent(corpus: DataFrame, stores: dict[str, DataFrame], key: str, place: str) -> DataFrame:
    """(store, n, missing, more, moved): for each store the corpus' keys that it lacks, those that the corpus lacks, and
    keys that stand at another place (L6). All 0 but n: the store's keys are the corpus', in its order."""
    out = []
    for name, store in stores.items():
        both = corpus.select(key, F.col(place).alias("_x")).join(store.select(key, F.col(place).alias("_y")), key, "full")
        count = lambda c: F.coalesce(F.count_if(c), F.lit(0))
        out.append(both.agg(F.count("_y").alias("n"), count(F.col("_y").isNull()).alias("missing"), count(F.col("_x").isNull()).alias("more"), count(F.col("_x") != F.col("_y")).alias("moved")).withColumn("store", F.lit(name)))
    return union(*out)


def presence(df: DataFrame, key: str, column: str, values: list[str], blank: str = "_") -> DataFrame:
    """One boolean column a value, and a pattern (K6-K8): the values present, and for absent ones as many blanks as their names are
    long, with bars between; without a blank absent ones are left out."""
    wide = df.groupBy(key).agg(*(F.bool_or(F.col(column).eqNullSafe(v)).alias(v) for v in values))
    return wide.withColumn("pattern", F.concat_ws("|", *(F.when(F.col(v), v).otherwise(blank * len(v) or None) for v in values)))


def first_by(df: DataFrame, key: str, order: list) -> DataFrame:
    """One row a key, the first in an order of columns (1.4): ascending, nulls last; for a descending number its negative.
    Tasks pass on one row a key at most."""
    columns = [F.col(c) if isinstance(c, str) else c for c in order]
    place = F.struct(*(F.struct(c.isNull().alias("none"), c.alias("value")) for c in columns))
    return df.groupBy(F.col(key).alias("_key")).agg(F.min_by(F.struct(*df.columns), place).alias("_r")).select("_r.*")
