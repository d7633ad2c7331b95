"""Named queries over the given tables, one per operator.

Lists come out as text joined with ``|`` and times as text, so that any SQL
engine can be compared value by value.
"""

from __future__ import annotations

from collections.abc import Callable
from datetime import timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, feeds, text, urls
from ..operators import (briefing, dedupe, filters, health, neardup, quality,
                         ranking, rollups, scoring, sections)
from ..operators.enrichment import Features, enrich, require_fields, with_timestamps
from ..schemas import CURATED_COLUMNS, LIST_COLUMNS
from ..session import cut_lineage, new_work_path, spread
from ..sources import curated as curated_store
from ..sources import feed_documents, landing, registry
from ..streaming import incremental
from .article_view import AS_OF, DAYS, articles, raw_articles, table
from .curate import curate, with_event_time

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}


def query(fn: Query) -> Query:
    """Register a query under its function name."""
    QUERIES[fn.__name__] = fn
    return fn


def _bar(name: str) -> Column:
    return F.array_join(name, "|").alias(name)


def _time(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


def _day(name: str) -> Column:
    return F.date_format(name, "yyyy-MM-dd").alias(name)


def flat(df: DataFrame) -> DataFrame:
    """Lists, times and dates as text."""
    kinds = dict(df.dtypes)
    return df.select(*[
        _bar(c) if kinds[c].startswith("array<string") else
        _time(c) if kinds[c] == "timestamp" else
        _day(c) if kinds[c] == "date" else F.col(c) for c in df.columns])


def enriched(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tagged articles of the whole view."""
    return enrich(with_timestamps(articles(spark, sf_dir)))


def curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated articles as a plan."""
    return curate(raw_articles(spark, sf_dir), AS_OF, DAYS)


def stored_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated articles as a stored table, for queries that read it often."""
    return cut_lineage(curated(spark, sf_dir), "curated")


# --- text, URL and date functions -----------------------------------------

def _odd_url() -> Column:
    """Page address with parameters that are hard to re-encode."""
    base = F.split_part("url", F.lit("#"), F.lit(1))
    return F.concat(
        base, F.when(F.contains(base, F.lit("?")), F.lit("&")).otherwise(F.lit("?")),
        F.lit("q=a*b~c%20d+e%zz&UTM_Medium=x&empty=&flag&&at_x=1&Ref=9&n="),
        F.col("page_id").cast("string"), F.lit("#frag"))


@query
def canonical_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return pages.select("page_id", urls.canonicalize_url(F.col("url")).alias("canonical_url"),
                        urls.canonicalize_url(_odd_url()).alias("odd_url"))


@query
def article_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    return articles(spark, sf_dir).select("doc_id", "article_id")


@query
def html_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spread(table(spark, sf_dir, "pages").select("page_id", "html"))
    return pages.select("page_id", text.strip_html(F.col("html")).alias("plain"))


@query
def title_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = articles(spark, sf_dir)
    return rows.select("doc_id", text.title_key(F.col("title")).alias("title_key"))


@query
def feed_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Event times written the ways feeds write them, and read back."""
    rows = spread(table(spark, sf_dir, "events").select(
        "event_id", F.date_trunc("second", "ts").alias("ts")))
    stamp = F.col("ts")
    written = {
        "rfc": F.date_format(stamp, "EEE, dd MMM yyyy HH:mm:ss '+0000'"),
        "rfc_zone": F.date_format(stamp, "d MMM yy HH:mm:ss 'EST'"),
        "iso_z": F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss'Z'"),
        "iso_offset": F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss'+02:00'"),
        "iso_day": F.date_format(stamp, "yyyy-MM-dd"),
        "iso_tail": F.date_format(stamp, "yyyy-MM-dd'T'HH:mm:ss' approx.'"),
        "bad": F.date_format(stamp, "HH:mm"),
    }
    read = {n: dates.parse_datetime(c) for n, c in written.items()}
    read["html"] = dates.date_from_html(F.concat(
        F.lit('<p>x</p><time class="a" dateTime="'), written["iso_offset"], F.lit('">day</time>')))
    return rows.select("event_id", *[
        F.date_format(c, "yyyy-MM-dd HH:mm:ss").alias(n) for n, c in read.items()])


@query
def relay_titles(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = articles(spark, sf_dir).select(
        "doc_id", "source_name",
        F.concat(F.col("title"), F.lit(" - "), F.col("source_name")).alias("named"),
        F.concat(F.col("title"), F.lit(" - news.example")).alias("domain"), "title")
    return rows.select(
        "doc_id",
        feeds.strip_publisher_suffix(F.col("named"), F.col("source_name")).alias("named"),
        feeds.strip_publisher_suffix(F.col("domain"), F.lit(None).cast("string")).alias("domain"),
        feeds.strip_publisher_suffix(F.col("title"), F.lit("")).alias("plain"))


@query
def relay_urls(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    words = F.concat(F.lit("site:"), registry.endpoint(F.col("url")),
                     F.lit(" (climate OR energy) when:7d"))
    return pages.select("page_id", urls.relay_url(words).alias("relay_url"))


# --- tags and score ---------------------------------------------------------

@query
def pillar_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched(spark, sf_dir).select("doc_id", _bar("esg_pillars"))


@query
def regulation_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched(spark, sf_dir).select("doc_id", _bar("regulations"))


@query
def topic_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched(spark, sf_dir).select("doc_id", _bar("topics"))


@query
def market_tags(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched(spark, sf_dir).select("doc_id", _bar("markets"), "is_eu", "is_us")


@query
def relevance_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched(spark, sf_dir).select("doc_id", "relevance_score", "has_publish_date")


@query
def custom_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A caller's own scorer in place of the default one."""
    def share_of_tags(f: Features) -> Column:
        tags = F.size(f.esg_pillars) + F.size(f.topics) + F.size(f.regulations)
        return tags.cast("double") / F.lit(32.0)

    rows = enrich(with_timestamps(articles(spark, sf_dir)), scorer=share_of_tags)
    return rows.select("doc_id", "relevance_score")


# --- filters and curation ---------------------------------------------------

@query
def required_fields(spark: SparkSession, sf_dir: str) -> DataFrame:
    return require_fields(articles(spark, sf_dir)).select("doc_id")


@query
def window_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_timestamps(articles(spark, sf_dir).select("doc_id", "published_at", "fetched_at"))
    kept = rows.filter(filters.in_window(F.col("published_ts"), AS_OF, DAYS))
    return kept.select("doc_id", _time("published_ts"))


@query
def relevance_gate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return enriched(spark, sf_dir).filter(filters.is_relevant()).select("doc_id", "relevance_score")


@query
def url_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_event_time(enriched(spark, sf_dir), AS_OF)
    best = dedupe.by_url(rows.filter(F.col("url") != ""))
    return best.select("dedupe_key", "doc_id", "source_id", "relevance_score", _time("event_ts"))


@query
def title_dedupe(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = with_event_time(enriched(spark, sf_dir), AS_OF)
    best = dedupe.by_title_and_day(dedupe.by_url(rows.filter(F.col("url") != "")))
    return best.select("title_key", _day("published_date"), "doc_id", "duplicate_count")


@query
def curated_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(curated(spark, sf_dir))


#: Weights of a linear model whose scores reach into the millions.
MODEL_WEIGHTS = {"pillars": 150000.25, "regulations": 40000.5, "topics": 1250.75,
                 "regulator": 300000.0, "no_summary": -75.25}


def model_curated(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated articles with the scores of a model in place of the points."""
    scorer = scoring.model_scorer("catalog-linear", scoring.linear(MODEL_WEIGHTS))
    return curate(raw_articles(spark, sf_dir), AS_OF, DAYS, scorer=scorer)


@query
def model_market_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Averages of a model's scores per market and day."""
    return flat(rollups.by_market_day(model_curated(spark, sf_dir)))


@query
def model_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The best stories by a model's scores, retellings left out."""
    stored = cut_lineage(model_curated(spark, sf_dir), "model-curated")
    top = ranking.number_stories(ranking.select_top(stored))
    return top.select("rank", "article_id", "title", "relevance_score", _day("published_date"))


# --- rollups ----------------------------------------------------------------

@query
def market_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(rollups.by_market_day(curated(spark, sf_dir)))


@query
def by_regulation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.by_regulation(curated(spark, sf_dir))


@query
def by_topic(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.by_topic(curated(spark, sf_dir))


@query
def by_pillar(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.by_pillar(curated(spark, sf_dir))


@query
def by_source(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.by_source(curated(spark, sf_dir))


@query
def site_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.site_counts(curated(spark, sf_dir))


@query
def site_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return rollups.site_summary(curated(spark, sf_dir))


# --- ranking and browsing ---------------------------------------------------

@query
def digest_top25(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.digest(curated(spark, sf_dir))


@query
def digest_us(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ranking.digest(curated(spark, sf_dir), market="us")


@query
def slim_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(ranking.browse(ranking.slim(curated(spark, sf_dir)), "date"))


@query
def article_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Browse filter: governance stories of one market that say 'climate'."""
    return flat(ranking.browse(_searched(ranking.slim(curated(spark, sf_dir)))))


def _searched(slim: DataFrame) -> DataFrame:
    return filters.search(slim, text="Climate", market="EU_US", pillar="G")


@query
def briefing_top20(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = ranking.number_stories(ranking.select_top(stored_curated(spark, sf_dir)))
    return top.select("rank", "article_id", "title", "relevance_score", _day("published_date"))


@query
def briefing_top20_eu(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = ranking.select_top(stored_curated(spark, sf_dir), markets=["eu"], collapse=False)
    return ranking.number_stories(top).select("rank", "article_id", "relevance_score")


@query
def section_routing(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = sections.with_section(curated(spark, sf_dir))
    return rows.select("article_id", "strength_e", "strength_s", "strength_g",
                       "strength_finance", "section")


# --- near duplicates --------------------------------------------------------

@query
def token_signatures(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = articles(spark, sf_dir)
    tokens = F.array_sort(text.token_signature(F.col("title"), F.col("summary")))
    return rows.select("doc_id", F.array_join(tokens, "|").alias("tokens"))


def _links(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Stories named by the order among equal ranks, and the links of these names."""
    rows = (stored_curated(spark, sf_dir).withColumn("_rank", ranking.rank_value())
            .select(ranking.tie_value().alias("article_id"), "_rank", "title", "summary"))
    return rows, neardup.near_duplicate_links(rows, "_rank")


def _plain(name: str) -> Column:
    return F.split_part(F.col(name), F.lit("/"), F.lit(2)).alias(name)


@query
def near_dup_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every retelling with the kept story it repeats."""
    rows, links = _links(spark, sf_dir)
    sigs = neardup.signatures(rows, "_rank")
    late = sigs.select(F.col("id").alias("article_id"), F.col("tokens").alias("a"))
    early = sigs.select(F.col("id").alias("kept_id"), F.col("tokens").alias("b"))
    pairs = links.filter("leader IS NOT NULL").select(
        F.col("id").alias("article_id"), F.col("leader").alias("kept_id"))
    return pairs.join(late, "article_id").join(early, "kept_id").select(
        _plain("article_id"), _plain("kept_id"), neardup.overlap(F.col("a"), F.col("b")).alias("shared"),
        F.least(F.size("a"), F.size("b")).alias("smaller"))


@query
def near_dup_collapse(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (_links(spark, sf_dir)[1].filter("leader IS NULL")
            .select(F.col("id").alias("article_id")).select(_plain("article_id")))


# --- feeds ------------------------------------------------------------------

def feed_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Registry of the sources that occur in the documents."""
    number = F.substring("id", 4, 9).cast("int")
    ids = table(spark, sf_dir, "documents").select(F.col("source").alias("id")).distinct()
    return ids.select(
        "id", F.concat(F.lit("Source "), number.cast("string")).alias("name"),
        F.concat(F.lit("https://feeds.example/"), "id", F.lit("/rss")).alias("url"),
        F.when(number % 3 == 0, "EU").when(number % 3 == 1, "US").otherwise("GLOBAL").alias("market"),
        F.when(number % 5 == 0, "regulator").when(number % 7 == 0, "ngo")
        .otherwise("media").alias("source_type"),
        F.lit("en").alias("language"),
        F.when(number % 4 == 3, F.lit("google_news")).alias("via"))


def _xml(column: Column) -> Column:
    """Text as XML character data."""
    out = column
    for char, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        out = F.replace(out, F.lit(char), F.lit(entity))
    return out


def snapshots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A fetch log with one feed snapshot per document, in three dialects.

    Each holds the document as an item and an item without a link.
    """
    rows = articles(spark, sf_dir).withColumn("_at", dates.parse_datetime(F.col("published_at")))
    link = _xml(F.coalesce("url", F.lit("")))
    html = _xml(F.concat(F.lit("<p>"), F.col("summary"), F.lit("</p>")))
    shown = _xml(F.concat(F.col("title"), F.when(
        (F.col("title") != "") & (F.substring("source_id", 4, 9).cast("int") % 4 == 3),
        F.lit(" - wire.example")).otherwise("")))
    labels = F.array_join(F.transform("categories", lambda c: F.concat(
        F.lit("<category> "), c, F.lit("</category>"))), "")
    rfc = F.coalesce(F.concat(F.lit("<pubDate>"), F.date_format(
        "_at", "EEE, dd MMM yyyy HH:mm:ss '+0000'"), F.lit("</pubDate>")), F.lit(""))
    iso = F.coalesce(F.date_format("_at", "yyyy-MM-dd'T'HH:mm:ss'Z'"), F.lit(""))
    author = F.coalesce("author", F.lit(""))
    empty = F.lit("<item><title>No link</title></item>")

    def cat(*parts: Column | str) -> Column:
        return F.concat(*[F.lit(p) if isinstance(p, str) else p for p in parts])

    rss = cat('<rss version="2.0" xmlns:dc="http://purl.org/dc/elements/1.1/"><channel>',
              empty, "<item><title>", shown, "</title><link>", link, "</link><description>",
              F.coalesce(html, F.lit("")), "</description>", rfc, "<dc:creator>", author,
              "</dc:creator>", labels, "<source>wire.example</source></item></channel></rss>")
    atom = cat('<feed xmlns="http://www.w3.org/2005/Atom"><entry><title>', shown,
               '</title><link rel="self" href="https://self.example"/><link href="',
               F.replace(link, F.lit('"'), F.lit("&quot;")), '"/><summary>',
               F.coalesce(html, F.lit("")), "</summary><updated>", iso,
               "</updated><author><name>", author, "</name></author>", labels,
               "<source>wire.example</source></entry></feed>")
    rdf = cat('<rdf:RDF xmlns:rdf="http://www.w3.org/1999/02/22-rdf-syntax-ns#" '
              'xmlns="http://purl.org/rss/1.0/" xmlns:dc="http://purl.org/dc/elements/1.1/">',
              empty, "<item><title>", shown, "</title><link>", link, "</link><description>",
              F.coalesce(html, F.lit("")), "</description><dc:date>", iso, "</dc:date><dc:creator>",
              author, "</dc:creator>", labels, "<source>wire.example</source></item></rdf:RDF>")
    kind = F.col("doc_id") % 4
    body = (F.when(kind == 0, rss).when(kind == 1, atom).when(kind == 2, rdf)
            .otherwise(F.concat(F.lit('<?xml version="1.0"?>'), rss)))
    # Every hundredth snapshot is cut off and so no well-formed XML.
    body = F.when(F.col("doc_id") % 100 == 7, F.concat(body, F.lit("<"))).otherwise(body)
    return rows.select(
        "source_id", "feed_url", F.lit(200).alias("status"),
        F.encode(body, "UTF-8").alias("body"), F.lit(None).cast("string").alias("error"),
        F.lit(False).alias("not_modified"), dates.parse_datetime(F.col("fetched_at")).alias("fetched_at"))


@query
def feed_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(feed_documents.parse_feeds(snapshots(spark, sf_dir), feed_table(spark, sf_dir)))


@query
def feed_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return registry.select_feeds(feed_table(spark, sf_dir), markets=["eu"],
                                 source_types=["Media", "regulator"]).select("id", "market", "source_type")


@query
def live_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Feeds without those whose endpoint had a failing fetch of kind 9."""
    dead = (table(spark, sf_dir, "events")
            .filter((F.col("event_type") == "error") & (F.get_json_object("props", "$.k") == "9"))
            .select(F.concat(F.lit("feeds.example/src"), (F.col("user_id") % 40).cast("string"),
                             F.lit("/rss")).alias("endpoint")).distinct())
    return registry.without_dead(feed_table(spark, sf_dir), dead).select("id", "url")


def fetch_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The event table read as a log of fetches, one run per day."""
    e = table(spark, sf_dir, "events")
    source = F.concat(F.lit("src"), (F.col("user_id") % 17).cast("string"))
    kind = F.col("event_type")
    return e.select(
        F.date_format("ts", "yyyy-MM-dd").alias("run_id"), source.alias("source_id"),
        F.concat(F.lit("https://feeds.example/"), source, F.lit("/rss")).alias("feed_url"),
        F.when(kind == "error", 500).when(kind == "signup", 304).otherwise(200).alias("status"),
        F.when(kind.isin("click", "view", "purchase"), F.encode("props", "UTF-8")).alias("body"),
        F.when(kind == "error", F.concat(F.lit("HTTPError: "), "props")).alias("error"),
        (kind == "signup").alias("not_modified"), F.col("ts").alias("fetched_at"))


def fetched_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as items of those runs."""
    d = table(spark, sf_dir, "documents").select("doc_id", "source", "n_chars")
    day = F.date_add(F.to_date(F.lit("2024-01-01")), (F.col("doc_id") % 30).cast("int"))
    published = F.date_sub(day, (F.col("n_chars") % 11 - 1).cast("int"))
    return d.select(
        F.date_format(day, "yyyy-MM-dd").alias("run_id"), F.col("source").alias("source_id"),
        F.when(F.col("doc_id") % 17 != 0, published.cast("timestamp")).alias("published_ts"),
    ).withColumn("published_at", dates.iso_utc(F.col("published_ts")))


@query
def feed_health(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.health_report(health.feed_health(
        feed_table(spark, sf_dir), fetch_log(spark, sf_dir), fetched_items(spark, sf_dir)))


@query
def healthy_feeds(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.healthy_total(health.feed_health(
        feed_table(spark, sf_dir), fetch_log(spark, sf_dir), fetched_items(spark, sf_dir)))


@query
def ingest_feed_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return health.feed_stats(fetch_log(spark, sf_dir), fetched_items(spark, sf_dir), DAYS)


def _failures_flat(stats: DataFrame) -> DataFrame:
    return stats.withColumn("failures", F.array_join(F.transform(
        "failures", lambda f: F.concat_ws(" ", f["source_id"], f["url"], f["error"])), "|"))


@query
def ingest_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _failures_flat(health.run_stats(ingest_feed_stats(spark, sf_dir)))


# --- briefings --------------------------------------------------------------

def with_reports(rows: DataFrame) -> DataFrame:
    """One report per day and market."""
    return rows.withColumn("report_id", F.concat_ws(
        "/", F.date_format("published_date", "yyyy-MM-dd"), "primary_market"))


def stories(spark: SparkSession, sf_dir: str, n: int = ranking.TOP_STORIES) -> DataFrame:
    """The best stories of one report per day and market."""
    return briefing.top_per_report(with_reports(curated(spark, sf_dir)), n)


def analyses(spark: SparkSession, sf_dir: str, chosen: DataFrame) -> DataFrame:
    """Conversation turns standing in for what a model wrote about a story."""
    talks = table(spark, sf_dir, "conversations")

    def turn(n: int, name: str) -> Column:
        return F.max(F.when(F.col("turn") % 4 == n, F.col("text"))).alias(name)

    answers = talks.groupBy("conv_id").agg(
        turn(0, "what_happened"), turn(1, "why_it_matters"),
        turn(2, "who_may_be_affected"), turn(3, "what_to_watch_next"))
    # One story in five gets a number that no conversation has.
    numbers = (talks.agg(F.max("conv_id")).first()[0] + 1) * 5 // 4
    conv = F.pmod(F.dayofmonth("published_date") * 20 + F.col("rank"), F.lit(numbers))
    return (chosen.select("report_id", "rank", conv.cast("bigint").alias("conv_id"))
            .join(answers, "conv_id").drop("conv_id"))


def bullets(chosen: DataFrame) -> DataFrame:
    """Headlines of the best stories as summary bullets, to be cleaned."""
    raw = F.concat(F.when(F.col("rank") % 3 == 0, F.lit(" - ")).otherwise(F.lit("• ")), "title",
                   F.lit("  "))
    pieces = F.array_sort(F.collect_list(F.struct("rank", raw.alias("text"))))
    return chosen.groupBy("report_id").agg(briefing.clean_bullets(
        F.transform(pieces, lambda p: p["text"])).alias("bullets"))


def stored_stories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stories with section, points and rank, stored because they are read
    several times."""
    chosen = cut_lineage(sections.with_section(stories(spark, sf_dir)), "stories")
    return briefing.with_analyses(chosen, analyses(spark, sf_dir, chosen))


def definitions(wanted: DataFrame) -> DataFrame:
    """Answers to the glossary question: repeated, unasked and missing terms."""
    base = wanted.filter(F.length("term") % 5 != 0)
    first = base.select("report_id", F.col("position").alias("pos"), "term", F.lit("Draft.").alias("meaning"))
    final = base.select("report_id", (F.col("position") + 1000).alias("pos"),
                        F.concat(F.lit(" "), F.upper("term")).alias("term"),
                        F.concat(F.lit("Meaning of "), "term", F.lit("..")).alias("meaning"))
    unasked = wanted.select("report_id", F.lit(5000).alias("pos"), F.lit("Unasked").alias("term"),
                            F.lit("Nothing.").alias("meaning")).distinct()
    return first.unionByName(final).unionByName(unasked)


def reports(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(reports, stories): assembled briefings with their glossary."""
    chosen = stored_stories(spark, sf_dir)
    points = bullets(chosen)
    body = briefing.assemble(briefing.report_lines(chosen, points))
    wanted = cut_lineage(briefing.glossary_terms(body), "wanted")
    terms = briefing.glossary(wanted, definitions(wanted))
    full = briefing.assemble(briefing.report_lines(chosen, points, terms))
    return cut_lineage(full, "reports"), chosen


def briefings(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(reports, stories) from start to end: of each report the best stories that
    retell no better one, sections, points, summary, glossary and header."""
    picked = briefing.distinct_per_report(
        cut_lineage(with_reports(curated(spark, sf_dir)), "report-stories"), ranking.TOP_STORIES)
    chosen = cut_lineage(sections.with_section(picked), "stories")
    chosen = briefing.with_analyses(chosen, analyses(spark, sf_dir, chosen))
    points = bullets(chosen)
    body = briefing.assemble(briefing.report_lines(chosen, points))
    wanted = cut_lineage(briefing.glossary_terms(body), "wanted")
    terms = briefing.glossary(wanted, definitions(wanted))
    full = briefing.assemble(briefing.report_lines(chosen, points, terms))
    return cut_lineage(full, "briefings"), chosen


@query
def briefing_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whole briefings, one per day and market, as they are published."""
    done, chosen = briefings(spark, sf_dir)
    return briefing.finished(done, chosen, DAYS, "given-model", filters.lit_timestamp(AS_OF))


@query
def briefing_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the audit finds in the bodies of whole briefings."""
    done, chosen = briefings(spark, sf_dir)
    return quality.audit(done, chosen)


@query
def batch_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return briefing.batch_prompts(stories(spark, sf_dir))


@query
def summary_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return briefing.summary_prompts(stories(spark, sf_dir))


@query
def retry_prompts(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = cut_lineage(stories(spark, sf_dir), "stories")
    return briefing.missing_analyses(chosen, analyses(spark, sf_dir, chosen))


@query
def story_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = stored_stories(spark, sf_dir)
    return chosen.select("report_id", "rank", briefing.story_block().alias("block"))


@query
def summary_bullets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return flat(bullets(stories(spark, sf_dir)))


@query
def section_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    top = ranking.number_stories(ranking.select_top(stored_curated(spark, sf_dir)))
    groups = sections.group_by_section(sections.with_section(top))
    return groups.select("section", F.array_join(F.transform(
        "stories", lambda s: F.concat_ws(":", s["rank"].cast("string"), s["article_id"])), "|").alias("stories"))


@query
def report_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return reports(spark, sf_dir)[0]


@query
def report_glossary(spark: SparkSession, sf_dir: str) -> DataFrame:
    chosen = stored_stories(spark, sf_dir)
    body = briefing.assemble(briefing.report_lines(chosen, bullets(chosen)))
    wanted = cut_lineage(briefing.glossary_terms(body), "wanted")
    return briefing.glossary(wanted, definitions(wanted))


@query
def report_headers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return briefing.report_header(stories(spark, sf_dir))


@query
def latest_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    done = reports(spark, sf_dir)[0]
    return briefing.latest_report(done.withColumn("report_date", F.substring("report_id", 1, 10)))


@query
def report_citations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return briefing.citations(reports(spark, sf_dir)[0]).drop("line_no")


def damaged(done: DataFrame) -> DataFrame:
    """Reports with faults that depend on the day, for the audit."""
    text = F.col("markdown")
    day = F.substring("report_id", 9, 2).cast("int") % 6
    return done.withColumn("markdown", (
        F.when(day == 0, F.replace(text, F.lit("## Executive Summary"), F.lit("## Overview")))
        .when(day == 1, F.replace(text, F.lit("What to watch next"), F.lit("Next")))
        .when(day == 2, F.replace(text, F.lit("https://"), F.lit("")))
        .when(day == 3, F.replace(F.replace(text, F.lit("## Terms Explained"), F.lit("## Notes")),
                                  F.lit("2026-08"), F.lit("August")))
        .when(day == 4, F.replace(text, F.lit("- •"), F.lit("")))
        .otherwise(text)))


@query
def report_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    done, chosen = reports(spark, sf_dir)
    return quality.audit(damaged(done), chosen)


@query
def uncited_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    done, chosen = reports(spark, sf_dir)
    return quality.missing_articles(damaged(done), chosen).select("report_id", "rank", "article_id")


@query
def term_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return briefing.term_counts(articles(spark, sf_dir).withColumn(
        "_body", F.concat_ws(" ", "title", "summary")), "_body")


# --- storage and streams ----------------------------------------------------

def _land_all(spark: SparkSession, sf_dir: str) -> str:
    path = new_work_path(spark, "landing")
    rows = articles(spark, sf_dir)
    day = F.date_sub(F.to_date(F.lit("2026-08-14")), (F.col("doc_id") % 3).cast("int"))
    landing.land(rows.withColumn("ingest_date", day).withColumn(
        "run_id", F.concat(F.date_format(day, "yyyyMMdd"), F.lit("T120000Z"))), path)
    return path


@query
def landing_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw articles written to a landing zone and read back."""
    return flat(landing.raw_rows(landing.read_landing(spark, _land_all(spark, sf_dir))))


def _land_damaged(spark: SparkSession, sf_dir: str) -> str:
    """The landing zone with lines cut off in some documents, and a stray file."""
    path = _land_all(spark, sf_dir)
    number = F.col("doc_id")
    day = F.date_sub(F.to_date(F.lit("2026-08-14")), (number % 3).cast("int"))
    line = F.concat(F.lit('{"article_id": "cut-'), number.cast("string"), F.lit('", "title": "half'))
    cut = table(spark, sf_dir, "documents").select("doc_id", line.alias("value"), day.alias(
        "ingest_date"), F.concat(F.date_format(day, "yyyyMMdd"), F.lit("T120000Z")).alias("run_id"))
    for rows, extension in ((cut.where(number % 50 == 3), "jsonl"), (cut.where(number % 50 == 4), "json")):
        (rows.drop("doc_id").write.mode("append").partitionBy("ingest_date", "run_id").format("csv")
         .options(quote="", sep="\x01", header="false", extension=extension).save(path))
    return path


@query
def landing_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    scan = landing.read_landing(spark, _land_damaged(spark, sf_dir))
    return flat(landing.quarantine_counts(scan))


@query
def landing_quarantine(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that are no valid rows, and whether the file named holds their run."""
    bad = landing.quarantine(landing.read_landing(spark, _land_damaged(spark, sf_dir)))
    place = F.concat(F.lit("/ingest_date="), F.col("ingest_date").cast("string"), F.lit("/run_id="),
                     "run_id", F.lit("/"))
    return flat(bad.select("ingest_date", "run_id", "line", F.contains("file", place).alias("in_place")))


@query
def curated_round_trip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curated articles written as Parquet by day and market and read back."""
    path = new_work_path(spark, "curated-store")
    curated_store.write_curated(curated(spark, sf_dir), path, filters.utc(AS_OF).date())
    return flat(curated_store.read_curated(spark, path).select(*CURATED_COLUMNS))


@query
def curated_csv(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The CSV export, all columns, written and read back."""
    path = new_work_path(spark, "curated-csv")
    rows = curated(spark, sf_dir)
    curated_store.write_csv(ranking.stringify_times(rows), path)
    kinds = {c: k for c, k in rows.dtypes if k in ("boolean", "bigint", "double")}
    return curated_store.read_csv(spark, path).select(*[
        F.col(c).cast(kinds[c]) if c in kinds else F.col(c) for c in CURATED_COLUMNS])


@query
def curated_jsonl(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The export as JSON lines, all columns, written and read back."""
    path = new_work_path(spark, "curated-jsonl")
    rows = curated(spark, sf_dir)
    curated_store.write_jsonl(rows, path)
    return flat(spark.read.schema(rows.schema).json(path).select(*CURATED_COLUMNS))


@query
def stored_rollup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A rollup written with the others from the stored table, read back."""
    base = new_work_path(spark, "rollups")
    where = curated_store.write_rollups(stored_curated(spark, sf_dir), base)
    return spark.read.parquet(where["by_topic"])


@query
def stored_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All rollups written from the stored table and read back, one below the other."""
    where = curated_store.write_rollups(stored_curated(spark, sf_dir), new_work_path(spark, "rollups"))
    none = F.lit(None)
    out = None
    for name, keys in (("by_market_day", ("primary_market", "published_date")),
                       ("by_regulation", ("regulation", "primary_market")), ("by_topic", ("topic",)),
                       ("by_pillar", ("pillar", "primary_market")), ("by_source", ("source_name",))):
        rows = spark.read.parquet(where[name])
        part = rows.select(
            F.lit(name).alias("rollup"), F.concat_ws("|", *[F.col(k).cast("string") for k in keys]).alias("key"),
            "article_count", (F.col("avg_relevance") if "avg_relevance" in rows.columns
                              else none.cast("double")).alias("avg_relevance"),
            (F.col("source_count") if "source_count" in rows.columns
             else none.cast("long")).alias("source_count"))
        out = part if out is None else out.unionByName(part)
    return out


def _stored_stats(spark: SparkSession, sf_dir: str) -> str:
    base = new_work_path(spark, "stats")
    per_feed = cut_lineage(ingest_feed_stats(spark, sf_dir), "feed-stats")
    curated_store.append_stats(per_feed, health.run_stats(per_feed), base)
    return base


@query
def stored_run_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Run statistics appended to their table and read back, failures included."""
    return _failures_flat(spark.read.parquet(f"{_stored_stats(spark, sf_dir)}/run_stats"))


@query
def stored_feed_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Statistics of feeds appended to their table and read back."""
    return spark.read.parquet(f"{_stored_stats(spark, sf_dir)}/feed_stats")


@query
def ingest_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Articles that ingest would land for a window of three days."""
    return landing.keep_window(articles(spark, sf_dir), AS_OF, 3).select("doc_id", "published_at")


@query
def unexpired_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Curation in which undated rows expire a day after they were fetched,
    seen two days later."""
    later = filters.utc(AS_OF) + timedelta(days=2)
    rows = curate(raw_articles(spark, sf_dir), later, DAYS, undated_max_age_days=1)
    return flat(rows.select("article_id", "source_id", "published_ts", "duplicate_count"))


@query
def incremental_curation(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Landed files tagged by a stream, then curated from the prepared table."""
    base = new_work_path(spark, "stream")
    incremental.prepare_new_files(spark, _land_all(spark, sf_dir), f"{base}/prepared",
                                  f"{base}/checkpoint").awaitTermination()
    return flat(incremental.curate_prepared(spark, f"{base}/prepared", AS_OF, DAYS))


@query
def parity_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many rows one-shot and incremental curation have, and how many differ."""
    left = cut_lineage(incremental_curation(spark, sf_dir), "incremental")
    right = cut_lineage(curated_articles(spark, sf_dir), "one-shot")
    counts = left.agg(F.count("*").alias("incremental_rows")).select("*", F.lit(1).alias("k")).join(
        right.agg(F.count("*").alias("one_shot_rows")).select("*", F.lit(1).alias("k")), "k")
    unlike = quality.differing_rows(left, right).agg(F.count("*").alias("unlike_rows"))
    return counts.join(unlike.select("*", F.lit(1).alias("k")), "k").drop("k")
