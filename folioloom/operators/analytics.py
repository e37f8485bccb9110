"""Corpus analytics: authors, streaks, co-authors, titles and terms."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.authors import author_field, author_identity, field_names, is_clean_surname
from ..functions.text import content_words, mostly_letters, squeeze, word_count
from ..runtime import cut

# Words no title is counted by.
STOPWORDS = """
a an the and or of in on for with to by from is are was were be been being it its as at this that these those into onto under over between among within
across throughout via vs without we i you he she they their our his her them us him me effect effects role roles study studies new not no does do using
used use can may might could would should also have has had which what whose whom whoever whoever whichever including none one two three four five six
seven eight nine ten preliminary report towards toward
""".split()
# What makes a title amusing.
AMUSING = (
    r"(?i)\b(?:rats?|mouse|mice|hamster|gerbil|pigeon|cats?|kitten|goldfish|chick|squirrel|monkey|beer|wine|chocolate|cookies?|coffee|alcohol|drinking|drunk"
    r"|sex|sexual|erotic|love|kiss(?:ing)?|flirt|zombie|brain[- ]?eating|cannibal|cannibalism|ghost|haunt(?:ed|ing)?|toilet|nausea|burp"
    r"|memory of memory|memory for memories|meta-meta|recursion|the the|but why|please|sorry|oops|whoops|self-?stimulation|kindling|brain stimulation)\b"
    r"|\?{2,}|!{2,}|^\s*why\b"
)


def mentions(records: DataFrame, group: str = "year", pos: str = "ingest_pos", authors: str = "authors_raw") -> DataFrame:
    """``pos, group, n, display, key``: each author of each record, by its place in the list."""
    names = F.posexplode(field_names(author_field(squeeze(F.coalesce(F.col(authors), F.lit(""))))))
    each = records.select(pos, group, names.alias("n", "name")).filter(is_clean_surname(F.col("name")))
    who = each.select(pos, group, "n", author_identity(F.col("name")).alias("w"))
    return who.select(pos, group, "n", "w.display", "w.key").filter("key <> ''")


def authors(m: DataFrame, group: str = "year", pos: str = "ingest_pos") -> DataFrame:
    """``key, display, n, n_groups, first_group, last_group, first_seen``; the shortest
    display stands, the earliest among equals."""
    # Groups are counted from their distinct pairs, so a hot author is no set in memory.
    pairs = m.groupBy("key", group).agg(F.count("*").alias("n"), F.min(F.struct(pos, "n")).alias("seen"), F.min(F.struct(F.when(F.length("display") > 0, F.length("display")), pos, "n", "display")).alias("d"))
    return pairs.groupBy("key").agg(F.min("d")["display"].alias("display"), F.sum("n").alias("n"), F.count("*").alias("n_groups"), F.min(group).alias("first_group"), F.max(group).alias("last_group"), F.min("seen").alias("first_seen"))


def top_authors(a: DataFrame, k: int) -> DataFrame:
    """The k most frequent authors with their place; ties to the first seen."""
    top = a.orderBy(F.desc("n"), "first_seen").limit(k)
    return top.withColumn("place", F.row_number().over(Window.orderBy(F.desc("n"), "first_seen"))).select("place", "key", "display", "n", "n_groups", "first_group", "last_group")


def top_by_group(m: DataFrame, group: str = "year", pos: str = "ingest_pos") -> DataFrame:
    """``group, key, n`` of each group's most frequent author; ties to the first met there."""
    counts = m.groupBy(group, "key").agg(F.count("*").alias("n"), F.min(F.struct(pos, "n")).alias("met"))
    best = counts.groupBy(group).agg(F.max(F.struct("n", F.struct(F.negative(f"met.{pos}"), F.negative("met.n")).alias("e"), "key")).alias("t"))
    return best.select(group, "t.key", "t.n")


def streaks(attended: DataFrame, who: str, when: str, at_least: int = 1) -> DataFrame:
    """``who, streak, first, last``: the longest run over the periods held, the earliest among equals.

    ``attended`` is (who, when) with repeats; gaps in the calendar are no gaps.
    """
    seen = attended.select(who, when).filter(F.col(who).isNotNull() & F.col(when).isNotNull()).distinct()
    calendar = seen.select(when).distinct().withColumn("_i", F.row_number().over(Window.orderBy(when)))  # the calendar: one row a period
    run = seen.join(calendar, when).withColumn("_run", F.col("_i") - F.row_number().over(Window.partitionBy(who).orderBy("_i")))
    runs = run.groupBy(who, "_run").agg(F.count("*").alias("streak"), F.min(when).alias("first"), F.max(when).alias("last"))
    best = runs.groupBy(who).agg(F.max_by(F.struct("streak", "first", "last"), F.struct("streak", F.negative("_run"))).alias("b"))
    return best.select(who, "b.streak", "b.first", "b.last").filter(F.col("streak") >= at_least)


def top_streaks(m: DataFrame, a: DataFrame, group: str = "year", k: int = 12, least: int = 5) -> DataFrame:
    """``place, key, display, streak, first, last`` of the k longest streaks of ``least``
    periods or more, ties to the author met first; first and last are the author's."""
    order = [F.desc("streak"), "first_seen"]
    top = streaks(m, "key", group, least).select("key", "streak").join(a, "key").orderBy(*order).limit(k)
    return top.withColumn("place", F.row_number().over(Window.orderBy(*order))).select("place", "key", "display", "streak", F.col("first_group").alias("first"), F.col("last_group").alias("last"))


def co_authors(m: DataFrame, pos: str = "ingest_pos", least: int = 2, least_node: int = 1) -> DataFrame:
    """``a, b, weight``: records two authors share. Pairs are made inside one
    record's list, so they are bounded by it and need no self-join."""
    busy = m.groupBy("key").agg(F.count("*").alias("c")).filter(F.col("c") >= least_node).select("key")
    lists = m.join(busy, "key", "left_semi").groupBy(pos).agg(F.array_sort(F.collect_set("key")).alias("ks")).filter(F.size("ks") > 1)
    pair = F.explode(F.flatten(F.transform("ks", lambda x, i: F.transform(F.slice("ks", i + 2, F.size("ks")), lambda y: F.struct(x.alias("a"), y.alias("b"))))))
    return lists.select(pair.alias("p")).groupBy("p.a", "p.b").agg(F.count("*").alias("weight")).filter(F.col("weight") >= least)


def components(edges: DataFrame) -> DataFrame:
    """``node, component``: the least node reachable from each. Each round takes
    the neighbours' least label and then the label of that label, so long
    chains close in few rounds; lineage is cut every round."""
    both = cut(edges.select("a", "b").unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct())
    label = cut(both.groupBy(F.col("a").alias("node")).agg(F.least(F.first("a"), F.min("b")).alias("component")))
    while True:
        near = both.join(label.select(F.col("node").alias("b"), "component"), "b").groupBy(F.col("a").alias("node")).agg(F.min("component").alias("m"))
        step = label.join(near, "node").select("node", F.least("component", "m").alias("m"), F.col("component").alias("was"))
        jump = step.join(label.select(F.col("node").alias("m"), F.col("component").alias("far")), "m", "left")
        new = cut(jump.select("node", F.least("m", F.coalesce("far", "m")).alias("component"), "was"))
        if new.filter("component <> was").isEmpty():
            return new.select("node", "component")
        label = new.select("node", "component")


def network_stats(edges: DataFrame, parts: DataFrame) -> DataFrame:
    """Nodes, edges and components of the graph without isolates, and the largest component (the least on ties)."""
    sizes = parts.groupBy("component").agg(F.count("*").alias("size"))
    top = sizes.agg(F.count("*").alias("components"), F.sum("size").alias("nodes"), F.max_by("component", F.struct("size", F.lit(0))).alias("_x"), F.max("size").alias("largest_size"))
    largest = sizes.join(F.broadcast(top.select(F.col("largest_size").alias("size"))), "size").agg(F.min("component").alias("largest"))
    total = edges.agg(F.count("*").alias("edges"))
    one = F.lit(1).alias("_1")
    return top.select("nodes", "components", "largest_size", one).join(total.select("edges", one), "_1").join(largest.select("largest", one), "_1").drop("_1")


def titled(records: DataFrame) -> DataFrame:
    t = F.col("title")
    return records.filter((F.coalesce(t, F.lit("")) != "") & mostly_letters(t)).withColumn("words", word_count(t))


def title_extremes(records: DataFrame, pos: str = "ingest_pos", k: int = 5, most: int = 40) -> DataFrame:
    """The k shortest titles of 2 to 5 words and the k longest of at most ``most``."""
    usable = titled(records).filter(F.col("words") <= most)
    short = usable.filter(F.col("words").between(2, 5)).orderBy("words", pos).limit(k).select(F.lit("shortest").alias("kind"), pos, "title", "words")
    long = usable.orderBy(F.desc("words"), F.desc(pos)).limit(k).select(F.lit("longest").alias("kind"), pos, "title", "words")
    return short.unionByName(long)


def amusing_titles(records: DataFrame, pos: str = "ingest_pos") -> DataFrame:
    from .segments import first_of

    pool = titled(records).filter(F.col("title").rlike(AMUSING) & F.col("words").between(4, 25)).select(pos, "year", "title")
    return first_of(pool, F.lower(F.regexp_replace("title", r"[^\p{L}\p{N}_]+", "")), [pos])


def over_represented(df: DataFrame, group: str, title: Column, keep: Column, least: int = 2) -> DataFrame:
    """``group, word, n, score``: the word most frequent in a group for its frequency
    overall, n over the root of the total; ties to the later word."""
    words = df.filter(keep).select(group, F.explode(content_words(title, STOPWORDS)).alias("word"))
    local = words.groupBy(group, "word").agg(F.count("*").alias("n"))
    total = local.groupBy("word").agg(F.sum("n").alias("all"))
    scored = local.filter(F.col("n") >= least).join(total, "word").withColumn("score", F.col("n") / F.sqrt("all"))
    return scored.groupBy(group).agg(F.max(F.struct("score", "word", "n")).alias("t")).select(group, "t.word", "t.n", F.round("t.score", 6).alias("score"))


def _list(df: DataFrame, order: list[str], fields: dict[str, str], name: str) -> DataFrame:
    """One row: a bounded table as an array of structs in order."""
    item = F.struct(*[F.col(c).alias(f"_{i}") for i, c in enumerate(order)], *[F.col(c).alias(n) for n, c in fields.items()])
    rows = df.agg(F.array_sort(F.collect_list(item)).alias("x"))
    return rows.select(F.transform("x", lambda s: F.struct(*[s[n].alias(n) for n in fields])).alias(name))


def stats_document(records: DataFrame, edges: DataFrame, parts: DataFrame, m: DataFrame, least_edge: int = 2, least_node: int = 1) -> DataFrame:
    """One row: the corpus statistics as a JSON text. Its lists hold ten authors,
    twelve streaks, five titles of each kind, and one author and one word a year."""
    a = cut(authors(m))
    named = top_by_group(m).join(a.select("key", "display"), "key").withColumnRenamed("n", "count")
    extremes = cut(title_extremes(records).join(records.select("ingest_pos", "year", F.coalesce("authors_raw", F.lit("")).alias("authors")), "ingest_pos").withColumn("back", F.when(F.col("kind") == "longest", -F.col("words")).otherwise(F.col("words"))).withColumn("at", F.when(F.col("kind") == "longest", -F.col("ingest_pos")).otherwise(F.col("ingest_pos"))))
    title = {"year": "year", "title": "title", "authors": "authors", "words": "words"}
    top = top_authors(a, 10).withColumn("years_span", F.array("first_group", "last_group"))
    words = over_represented(titled(records), "year", F.col("title"), F.lit(True)).withColumnRenamed("n", "count")
    parts_ = [
        records.agg(F.count("*").alias("total_records"), F.min("year").alias("first_year"), F.max("year").alias("last_year")),
        a.agg(F.count("*").alias("unique_authors")),
        _list(top, ["place"], {"name": "display", "count": "n", "years_span": "years_span"}, "top_authors"),
        _list(named, ["year"], {"year": "year", "name": "display", "count": "count"}, "yearly_top"),
        _list(top_streaks(m, a), ["place"], {"name": "display", "streak": "streak", "first": "first", "last": "last"}, "top_streaks"),
        *[_list(extremes.filter(F.col("kind") == kind), ["back", "at"], title, f"{kind}_titles") for kind in ("shortest", "longest")],
        network_stats(edges, parts).select(F.struct("nodes", "edges", F.lit(least_node).alias("node_threshold"), F.lit(least_edge).alias("edge_threshold")).alias("network")),
        _list(words, ["year"], {"year": "year", "word": "word", "count": "count"}, "yearly_word"),
    ]
    doc = parts_[0].withColumn("_1", F.lit(1))
    for p in parts_[1:]:
        doc = doc.join(p.withColumn("_1", F.lit(1)), "_1")  # one row each
    return doc.drop("_1").select(F.to_json(F.struct("*")).alias("stats"))
