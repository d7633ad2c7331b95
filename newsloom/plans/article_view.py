"""Articles built from the document and page tables.

The tables hold invented prose without headlines, dates or subject terms, so
this view gives every document a headline, a closing sentence, an address and
dates by fixed rules.  The rules are plain arithmetic, so SQL can state them
as well; the whole text of each document is kept as the summary.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.binding import lit_array
from ..functions.urls import article_id, canonicalize_url
from ..schemas import RAW_COLUMNS
from ..session import spread

AS_OF = "2026-08-14 12:00:00"
DAYS = 7

# (headline, closing sentence, categories); chosen by the length of the text,
# so that copies of a document share them.
STORIES: tuple[tuple[str, str, str], ...] = (
    ("Brussels adopts CSRD omnibus package", "The board welcomed the disclosure framework.", "Regulation|Reporting"),
    ("Court hears the SEC on its climate disclosure rule", "Lawyers in Washington expect a settlement.", "Law"),
    ("Green bond issuance reaches record", "Investors raised two billion in capital.", "Finance|Bonds"),
    ("Football club signs striker", "Fans cheered in the stadium.", "Sport"),
    ("Offshore wind farm secures power purchase agreement", "The grid operator announced battery storage.", "Energy"),
    ("CBAM carbon border adjustment starts", "Importers in Germany file reports on emissions.", "Trade|Climate"),
    ("Deforestation regulation delayed again", "Supply chain due diligence and traceability stay.", "EUDR"),
    ("Workforce diversity and human rights audit", "Modern slavery found at a supplier.", "Social"),
    ("Minister gives green light to airport", "The transition of power ends.", "Politics"),
    ("ISSB and TNFD align on materiality", "TCFD guidance and GRI standards follow.", "Reporting|Nature|Reporting"),
    ("California SB 253 and SB-261 upheld", "The Supreme Court declined the lawsuit.", "Law|Climate"),
    ("Bank fined over greenwashing", "A misleading claim cost the asset manager a fine.", "Finance"),
    ("EU ETS carbon price climbs", "Emissions trading system allowances and carbon credits rally.", "Markets"),
    ("Net-zero pledge by steel maker", "Hydrogen and renewables drive decarbonisation.", "Industry"),
    ("Recipe of the week", "Stir well and serve.", ""),
    ("SFDR review meets ESRS and CSDDD", "The EU taxonomy needs sustainability data.", "Finance|Regulation"),
    ("Congress debates omnibus spending bill", "The US Senate votes next week.", "Politics"),
    ("Inflation Reduction Act funds solar", "The DOE and the EPA set rules in the United States.", "Energy|Policy"),
    ("Paris Agreement stocktake urges methane cuts", "Climate finance and adaptation lag behind.", "Climate"),
    ("UK SDR labels for funds", "Stewardship codes and proxy voting change.", "Finance"),
    ("Green claims directive withdrawn", "The European Parliament and the ECB comment.", "Policy"),
    ("Bakery chain opens a third shop", "Customers queued before dawn.", "Business"),
    ("Climate CSRD", "Just transition plan and transition finance.", "Climate"),
    ("ESG", "Circular economy, biodiversity and governance.", ""),
)
SHORT_FROM = 22  # headlines from here on stay short


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the given tables."""
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _choice(index: Column, values: list[str]) -> Column:
    return F.element_at(lit_array(values), (index + 1).cast("int"))


def _iso(ts: Column) -> Column:
    return F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss'+00:00'")


def articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``doc_id`` and the raw article columns: all documents, whole texts."""
    pages = table(spark, sf_dir, "pages").select("page_id", F.col("url").alias("page_url"))
    n_pages = table(spark, sf_dir, "pages").count()  # answered from the file footers
    docs = spread(table(spark, sf_dir, "documents")
                  .select("doc_id", "text", "lang", "source", "n_chars"))
    joined = docs.join(pages, docs.doc_id % F.lit(n_pages) == pages.page_id)

    doc_id, n = F.col("doc_id"), F.col("n_chars")
    headline, ending = n % 24, F.floor(n / 24) % 24
    number = F.substring("source", 4, 9).cast("int")
    as_of = F.lit(AS_OF).cast("timestamp")
    published = (as_of - F.make_dt_interval(days=(n % 11 - 1).cast("int"))
                 - F.make_dt_interval(mins=(doc_id * 37 % 1440).cast("int")))
    fetched = as_of - F.make_dt_interval(secs=(doc_id % 600).cast("decimal(18,6)"))
    head = _choice(headline, [s[0] for s in STORIES])
    title = F.when(headline >= SHORT_FROM, head).otherwise(
        F.concat(head, F.lit(" - "), F.split_part("text", F.lit("."), F.lit(1))))
    rows = joined.select(
        "doc_id",
        F.when(doc_id % 101 == 0, F.lit("")).otherwise(title).alias("title"),
        F.when(doc_id % 103 != 0, F.col("page_url")).alias("url"),
        F.when(doc_id % 19 != 0, F.concat(
            "text", F.lit(" "), _choice(ending, [s[1] for s in STORIES]))).alias("summary"),
        F.when(doc_id % 4 != 0, F.concat(F.lit("Author "), (doc_id % 97).cast("string"))).alias("author"),
        F.when(doc_id % 17 == 0, F.lit(None)).when(doc_id % 53 == 0, F.lit("unknown"))
        .otherwise(_iso(published)).alias("published_at"),
        F.lit(None).cast("string").alias("published_raw"),
        F.filter(F.split(_choice(headline, [s[2] for s in STORIES]), r"\|"),
                 lambda x: x != "").alias("categories"),
        F.col("source").alias("source_id"),
        F.concat(F.lit("Source "), number.cast("string")).alias("source_name"),
        _choice(number % 3, ["EU", "US", "GLOBAL"]).alias("source_market"),
        F.when(number % 5 == 0, F.lit("regulator")).when(number % 7 == 0, F.lit("ngo"))
        .otherwise(F.lit("media")).alias("source_type"),
        F.col("lang").alias("language"),
        F.concat(F.lit("https://feeds.example/"), "source", F.lit("/rss")).alias("feed_url"),
        _iso(fetched).alias("fetched_at"),
    ).withColumn("canonical_url", canonicalize_url(F.col("url")))
    return rows.withColumn(
        "article_id", article_id(F.col("canonical_url"), F.col("url"))).select("doc_id", *RAW_COLUMNS)


def raw_articles(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The article view in raw shape."""
    return articles(spark, sf_dir).select(*RAW_COLUMNS)
