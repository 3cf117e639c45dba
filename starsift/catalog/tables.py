"""The given tables seen as reviews, labelled sentences and scored rows.

Each view is plain column work on the tables, so query work grows with them.
The SQL text of a view stands beside it.
"""

from __future__ import annotations

from collections.abc import Mapping
from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from starsift.catalog import sql as Q
from starsift.operators import clean
from starsift.operators.text import lexicon_sentiment
from starsift.plans.jobs import Preparation, prepare_columns
from starsift.session import cut_lineage
from starsift.sources.readers import with_row_id

REVIEW_ID = ["order_key", "line_no"]
PERIOD_CUTS = ("1997-03-01", "1999-07-01")
PERIODS = ("pre-COVID", "during-COVID", "post-COVID")
CLASSES = (
    ("desktop", r"\b(gear|gizmo)\b"),
    ("laptop", r"\b(plate|anvil)\b"),
    ("tablet", r"\b(ring|widget)\b"),
    ("phone", r"\b(rod)\b"),
)
BRANDS = r"\b(red|blue|hot|cold|large)\b"
ALIASES = {"hot": "red", "cold": "blue"}
EXCLUDED = "PROMO"

KEYWORDS = {
    "article": r"\b(?:the|der|la|le)\b",
    "and": r"\b(?:and|und|et|y)\b",
    "of the": r"\bof\s+the\b",
    "with": r"\bwith\b",
    "that / que": r"\b(?:that|que)\b",
}
LEXICON = {
    "that": 1.9, "with": 1.3, "for": -1.1, "are": -2.2, "this": 0.8, "by": -0.7, "que": 1.1,
    "und": -0.6, "los": 0.5, "pour": -1.4, "was": -1.6, "and": 0.3,
}
NEGATORS = ("is", "pas", "nicht")
BOOSTERS = ("of", "la")
HOW = Preparation(
    EXCLUDED, PERIOD_CUTS, CLASSES, BRANDS, ALIASES, r"\b(that|which|que)\b", NEGATORS, BOOSTERS
)

RV = """rv AS (
  SELECT l_orderkey AS order_key, l_linenumber AS line_no, l_partkey AS parent_asin,
    CAST(1 + CAST(l_quantity AS INTEGER) % 5 AS DOUBLE) AS rating, l_shipdate AS date,
    l_linestatus = 'O' AS verified_purchase, p_name AS product_title,
    CASE WHEN p_size % 5 <> 0 THEN l_extendedprice / 50 END AS price,
    1 + (p_size % 41) / 10e0 AS average_rating, CAST(p_size * 10 AS BIGINT) AS rating_number,
    p_type AS main_category, CAST(round(l_tax * 100) AS BIGINT) AS helpful_vote,
    (l_orderkey * 7 + l_linenumber) % (SELECT count(*) FROM documents) AS doc_id
  FROM lineitem JOIN part ON l_partkey = p_partkey)"""

TIER = """CASE WHEN price IS NULL OR price = 0 THEN 'Unknown' WHEN price >= q975 THEN 'Premium'
      WHEN price > q75 THEN 'High' WHEN price > q50 THEN 'Medium' ELSE 'Low' END"""
PERIOD = """CASE WHEN date IS NULL THEN 'unknown' WHEN date < TIMESTAMP '1997-03-01' THEN 'pre-COVID'
      WHEN date < TIMESTAMP '1999-07-01' THEN 'during-COVID' ELSE 'post-COVID' END"""
CATEGORY = """CASE split_part(product_title, ' ', 2) WHEN 'gear' THEN 'desktop' WHEN 'gizmo' THEN 'desktop'
      WHEN 'plate' THEN 'laptop' WHEN 'anvil' THEN 'laptop' WHEN 'ring' THEN 'tablet'
      WHEN 'widget' THEN 'tablet' WHEN 'rod' THEN 'phone' ELSE 'other' END"""
BRAND = """CASE split_part(product_title, ' ', 1) WHEN 'red' THEN 'red' WHEN 'hot' THEN 'red'
      WHEN 'blue' THEN 'blue' WHEN 'cold' THEN 'blue' WHEN 'large' THEN 'large' ELSE 'unknown' END"""

PR = f"""cut AS (
  SELECT quantile_cont(price, 0.5) AS q50, quantile_cont(price, 0.75) AS q75,
    quantile_cont(price, 0.975) AS q975
  FROM rv WHERE main_category IS DISTINCT FROM 'PROMO'),
pr AS (
  SELECT * FROM (
    SELECT rv.*, CAST(year(date) AS INTEGER) AS year, CAST(month(date) AS INTEGER) AS month,
      CAST(dayofmonth(date) AS INTEGER) AS date_of_month, dayname(date) AS day_of_week,
      CAST(price IS NULL AS INTEGER) AS price_missing,
      {TIER} AS price_tier, {PERIOD} AS covid_period,
      CASE WHEN parent_asin % 97 = 0 THEN 'desktop' ELSE {CATEGORY} END AS category,
      {BRAND} AS brand
    FROM rv, cut
    WHERE main_category IS DISTINCT FROM 'PROMO' AND parent_asin % 101 <> 0)
  WHERE category NOT IN ('other', 'phone'))"""

BASE = Q.ctes(RV, PR)
BASE_PARTS = (RV, PR)

WITH_LENGTH = """prl AS (SELECT pr.*, n_chars AS review_length FROM pr JOIN documents USING (doc_id))"""


def sql_words(source: str, key: str) -> str:
    return f"""words AS (
  SELECT {key}, i, word, lag(word, 1) OVER w AS b1, lag(word, 2) OVER w AS b2, lag(word, 3) OVER w AS b3
  FROM (SELECT {key}, unnest(ws) AS word, generate_subscripts(ws, 1) AS i FROM (
    SELECT {key}, list_filter(regexp_split_to_array(lower(coalesce(text, '')), '[^\\p{{L}}'']+'),
      lambda x: x <> '') AS ws FROM {source}))
  WINDOW w AS (PARTITION BY {key} ORDER BY i))"""


def sql_sentiment(source: str, key: str, words: Mapping[str, float] = LEXICON) -> str:
    """CTEs ending in `sentiment` with the key and `vader_sentiment`."""
    values = ", ".join(f"('{w}', {v!r}e0)" for w, v in words.items())
    no = ", ".join(f"'{w}'" for w in NEGATORS)
    up = ", ".join(f"'{w}'" for w in BOOSTERS)
    return f"""{sql_words(source, key)},
lexicon(word, valence) AS (VALUES {values}),
raw_sentiment AS (
  SELECT {key}, sum((valence + CASE WHEN coalesce(b1 IN ({up}), false) THEN sign(valence) * 0.293e0 ELSE 0e0 END)
    * CASE WHEN coalesce(b1 IN ({no}), false) OR coalesce(b2 IN ({no}), false) OR coalesce(b3 IN ({no}), false)
      THEN -0.74e0 ELSE 1e0 END) AS s
  FROM words JOIN lexicon USING (word) GROUP BY {key}),
sentiment AS (
  SELECT {key}, coalesce(s / sqrt(s * s + 15), 0e0) AS vader_sentiment
  FROM (SELECT {key} FROM {source}) LEFT JOIN raw_sentiment USING ({key}))"""


def sql_flags(names: Mapping[str, str] = KEYWORDS) -> str:
    """CTE `flags`: keyword flags of every document."""
    cells = ", ".join(
        f"CAST(regexp_matches(text, {Q.whole_word(p)}) AS INTEGER) AS kw_{i}"
        for i, p in enumerate(names.values())
    )
    return f"flags AS (SELECT doc_id, {cells} FROM documents)"


# Labelled sentences: one per order.
SL = """sl0 AS (
  SELECT concat('the ', prio, ' order of customer ', o_custkey, ' is ', state) AS sentence_for_model,
    CASE WHEN o_custkey % 7 = 0 THEN 0 ELSE 1 END AS is_related,
    CASE WHEN o_custkey % 7 = 0 OR o_orderkey % 4 = 0 THEN 0 ELSE 1 END AS is_technical,
    concat_ws(';', prio, state, CASE WHEN o_custkey % 5 = 0 THEN 'General ' END,
      CASE WHEN o_orderkey % 211 = 0 THEN 'Gift' END) AS target_aspect,
    CASE WHEN o_orderkey % 13 = 0 THEN s1
      ELSE concat_ws(';', s1, CASE WHEN o_orderkey % 17 = 0 THEN 'n/a' WHEN o_custkey % 3 = 0 THEN '-1'
        ELSE ' 1.0' END, CASE WHEN o_custkey % 5 = 0 THEN '0' END,
        CASE WHEN o_orderkey % 211 = 0 THEN '1' END) END AS target_sentiment
  FROM (SELECT *, lower(split_part(o_orderpriority, '-', 2)) AS prio,
      CASE o_orderstatus WHEN 'O' THEN 'open' WHEN 'F' THEN 'filled' ELSE 'pending' END AS state,
      CASE WHEN o_totalprice > 300000 THEN '1' WHEN o_totalprice < 100000 THEN '-1' ELSE '0' END AS s1
    FROM orders)),
sl AS (
  SELECT sha256(concat_ws(chr(31), 'v' || sentence_for_model, 'v' || is_related, 'v' || is_technical,
      'v' || target_aspect, 'v' || target_sentiment)) || '-' || row_number() OVER (
      PARTITION BY sentence_for_model, is_related, is_technical, target_aspect, target_sentiment) AS row_id, *
  FROM sl0)"""

PAIRS = """pairs AS (
  SELECT * FROM (
    SELECT row_id, sentence_for_model, is_related, is_technical, i,
      lower(trim(a[i])) AS aspect, CAST(trunc(TRY_CAST(trim(s[i]) AS DOUBLE)) AS INTEGER) AS sentiment
    FROM (SELECT *, unnest(range(1, len(a) + 1)) AS i FROM (
      SELECT *, string_split(target_aspect, ';') AS a, string_split(target_sentiment, ';') AS s FROM sl)
      WHERE len(a) = len(s)))
  WHERE aspect <> '' AND aspect NOT IN ('general', 'unrelated') AND sentiment IS NOT NULL),
tech AS (
  SELECT row_id, any_value(sentence_for_model) AS sentence_for_model,
    list(aspect ORDER BY i) AS aspects, list(sentiment ORDER BY i) AS sentiments
  FROM pairs WHERE is_related = 1 AND is_technical = 1 GROUP BY row_id)"""

COMBO = """combos AS (
  SELECT row_id, aspect || '_' || sentiment AS combo FROM pairs WHERE is_related = 1 AND is_technical = 1),
combo_n AS (SELECT combo, count(DISTINCT row_id) AS n FROM combos GROUP BY combo),
strat AS (
  SELECT row_id, min_by(combo, (n, combo)) AS rarest_combo FROM combos JOIN combo_n USING (combo) GROUP BY row_id)"""


def sql_split(name: str, source: str, strata: str, key: str = "row_id") -> str:
    """CTE: the source with `split`, 70/15/15 inside each stratum by digest order."""
    return f"""{name} AS (
  SELECT *, CASE WHEN rk <= floor(0.7e0 * size + 0.5e0) THEN 'train'
      WHEN rk <= floor((0.7e0 + 0.15e0) * size + 0.5e0) THEN 'val' ELSE 'test' END AS split
  FROM (SELECT *, row_number() OVER (PARTITION BY {strata} ORDER BY md5('42|' || {key})) AS rk,
      count(*) OVER (PARTITION BY {strata}) AS size FROM {source}))"""


TECH_SPLIT = f"""{COMBO},
ts0 AS (SELECT tech.*, rarest_combo FROM tech JOIN strat USING (row_id)),
{sql_split("ts", "ts0", "rarest_combo")}"""
REST_SPLIT = f"""rest0 AS (SELECT sl.* FROM sl WHERE row_id NOT IN (SELECT row_id FROM tech)),
{sql_split("rest", "rest0", "is_related")}"""

# Scored rows: quality labels with a repeatable score, aspect = language of the document.
SC = """sc AS (
  SELECT doc_id, quality AS y, (doc_id * 37 % 100) / 100e0 AS p, lang AS aspect,
    CAST((doc_id * 37 % 100) / 100e0 >= 0.5 AS INTEGER) AS z,
    greatest((doc_id * 37 % 100) / 100e0, 1 - (doc_id * 37 % 100) / 100e0) AS conf
  FROM labels JOIN documents USING (doc_id))"""


class Tables:
    """Lazy views over one table folder."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark = spark
        self.sf_dir = sf_dir.rstrip("/")
        self._tables: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        """A table; its footer is looked at once."""
        if name not in self._tables:
            self._tables[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._tables[name]

    def texts(self, name: str) -> DataFrame:
        """A table of long texts; the session's file split size decides its tasks."""
        return self.read(name)

    @cached_property
    def products(self) -> DataFrame:
        size = F.col("p_size")
        return self.read("part").select(
            F.col("p_partkey").alias("parent_asin"),
            F.col("p_name").alias("product_title"),
            "p_size",
            (F.lit(1) + (size % 41) / F.lit(10.0)).alias("average_rating"),
            (size * 10).cast("long").alias("rating_number"),
            F.col("p_type").alias("main_category"),
        )

    def linked(self, products: DataFrame) -> DataFrame:
        """Line items joined to parts, in review terms."""
        documents = self.read("documents").agg(F.count(F.lit(1))).scalar()
        lines = self.read("lineitem").select(
            F.col("l_orderkey").alias("order_key"),
            F.col("l_linenumber").alias("line_no"),
            F.col("l_partkey").alias("parent_asin"),
            (F.lit(1) + F.col("l_quantity").cast("int") % 5).cast("double").alias("rating"),
            F.col("l_shipdate").alias("date"),
            (F.col("l_linestatus") == "O").alias("verified_purchase"),
            F.col("l_extendedprice"),
            F.round(F.col("l_tax") * 100).cast("long").alias("helpful_vote"),
            ((F.col("l_orderkey") * 7 + F.col("l_linenumber")) % documents).alias("doc_id"),
        )
        labels = [c for c in ("title_class", "brand") if c in products.columns]
        return lines.join(products, "parent_asin").select(
            "order_key", "line_no", "parent_asin", "rating", "date", "verified_purchase",
            "product_title",
            F.when(F.col("p_size") % 5 != 0, F.col("l_extendedprice") / 50).alias("price"),
            "average_rating", "rating_number", "main_category", "helpful_vote", "doc_id", *labels,
        )

    @cached_property
    def reviews(self) -> DataFrame:
        return self.linked(self.products)

    @cached_property
    def overrides(self) -> DataFrame:
        """Product category corrections; some products are named twice."""
        p = self.read("part").select(F.col("p_partkey").alias("parent_asin"))
        first = p.where("parent_asin % 97 = 0").select(
            "parent_asin", F.lit("desktop").alias("category"), F.lit(1).alias("priority")
        )
        second = p.where("parent_asin % 194 = 0").select(
            "parent_asin", F.lit("laptop").alias("category"), F.lit(2).alias("priority")
        )
        return first.unionAll(second)

    @cached_property
    def denied(self) -> DataFrame:
        return self.read("part").select(F.col("p_partkey").alias("parent_asin")).where(
            "parent_asin % 101 = 0"
        )

    @cached_property
    def prepared(self) -> DataFrame:
        """The prepared columns; titles are matched once per product, before the join."""
        labelled = clean.label_products(
            self.products, "product_title", HOW.classes, HOW.brand_pattern, HOW.aliases()
        )
        return prepare_columns(self.linked(labelled), HOW, self.overrides, self.denied)

    @cached_property
    def lengths(self) -> DataFrame:
        return self.read("documents").select("doc_id", F.col("n_chars").alias("review_length"))

    @cached_property
    def with_length(self) -> DataFrame:
        return self.prepared.join(self.lengths, "doc_id")

    @cached_property
    def lexicon(self) -> DataFrame:
        return self.spark.createDataFrame(list(LEXICON.items()), "word string, valence double")

    @cached_property
    def doc_sentiment(self) -> DataFrame:
        return lexicon_sentiment(
            self.texts("documents"), self.lexicon, ["doc_id"], "text",
            negators=NEGATORS, boosters=BOOSTERS,
        )

    @cached_property
    def with_sentiment(self) -> DataFrame:
        return self.prepared.join(self.doc_sentiment, "doc_id")

    @cached_property
    def with_flags(self) -> DataFrame:
        """Prepared reviews with keyword flags; a text shared by reviews is matched once."""
        flags = clean.with_keyword_flags(self.texts("documents"), KEYWORDS, "text")
        names = list(clean.flag_columns(KEYWORDS).values())
        return self.prepared.join(flags.select("doc_id", *names), "doc_id")

    @cached_property
    def order_sentences(self) -> DataFrame:
        """One labelled sentence per order, as it would be read from a label file."""
        o = self.read("orders")
        prio = F.lower(F.split_part("o_orderpriority", F.lit("-"), F.lit(2)))
        state = (
            F.when(F.col("o_orderstatus") == "O", "open")
            .when(F.col("o_orderstatus") == "F", "filled")
            .otherwise("pending")
        )
        price, key, customer = F.col("o_totalprice"), F.col("o_orderkey"), F.col("o_custkey")
        s1 = F.when(price > 300000, "1").when(price < 100000, "-1").otherwise("0")
        s2 = F.when(key % 17 == 0, "n/a").when(customer % 3 == 0, "-1").otherwise(" 1.0")
        general, gift = customer % 5 == 0, key % 211 == 0
        return o.select(
            F.concat(
                F.lit("the "), prio, F.lit(" order of customer "), customer.cast("string"),
                F.lit(" is "), state,
            ).alias("sentence_for_model"),
            F.when(customer % 7 == 0, 0).otherwise(1).alias("is_related"),
            F.when((customer % 7 == 0) | (key % 4 == 0), 0).otherwise(1).alias("is_technical"),
            F.concat_ws(";", prio, state, F.when(general, "General "), F.when(gift, "Gift")).alias(
                "target_aspect"
            ),
            F.when(key % 13 == 0, s1)
            .otherwise(F.concat_ws(";", s1, s2, F.when(general, "0"), F.when(gift, "1")))
            .alias("target_sentiment"),
        )

    @cached_property
    def sentences(self) -> DataFrame:
        """Labelled sentences with their ids, stored once."""
        return cut_lineage(with_row_id(self.order_sentences))

    @cached_property
    def scored(self) -> DataFrame:
        p = (F.col("doc_id") * 37 % 100) / 100
        docs = self.read("documents").select("doc_id", F.col("lang").alias("aspect"))
        return (
            self.read("labels")
            .select("doc_id", F.col("quality").alias("y"), p.alias("p"))
            .join(docs, "doc_id")
            .withColumns(
                {
                    "z": (F.col("p") >= 0.5).cast("int"),
                    "conf": F.greatest(F.col("p"), 1 - F.col("p")),
                }
            )
        )
