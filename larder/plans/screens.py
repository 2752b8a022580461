"""Screens and answers: headers, buttons, OCR lines, price fields, brand splitting, scores and requests."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from larder.functions import fixed
from larder.functions import text as t
from larder.plans import views as v


def header_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether a screen's first and last box fit the expected layout: hard failure, issues, verdict."""
    s = v.box(spark, sf_dir).groupBy("screen").agg(F.min("y").alias("header"), F.max(F.col("y") + F.col("h")).alias("content"), F.count("*").alias("boxes"))
    issues = F.filter(
        F.array(
            F.when(~F.col("header").between(0, 300), F.lit("critical: header out of range")),
            F.when(F.col("content") > 1000, F.lit("content too long")),
            F.when(F.col("boxes") < 2, F.lit("few boxes")),
        ),
        lambda x: x.isNotNull(),
    )
    bad = F.exists("issues", lambda i: i.startswith("critical"))
    return s.withColumn("issues", issues).select("screen", F.size("issues").alias("n"), F.array_join("issues", "; ").alias("issues"), (~bad).alias("compatible"))


HEADER_CHECK = f"""WITH {v.BOX}, s AS (SELECT screen, min(y) AS header, max(y + h) AS content, count(*) AS boxes FROM v_box GROUP BY screen),
i AS (SELECT screen, list_filter([CASE WHEN header NOT BETWEEN 0 AND 300 THEN 'critical: header out of range' END, CASE WHEN content > 1000 THEN 'content too long' END, CASE WHEN boxes < 2 THEN 'few boxes' END], lambda x: x IS NOT NULL) AS issues FROM s)
SELECT screen, len(issues)::INT AS n, array_to_string(issues, '; ') AS issues, len(list_filter(issues, lambda x: starts_with(x, 'critical'))) = 0 AS compatible FROM i"""


def best_button(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The most likely button of a screen: area and shape in range, confidence from both, in thousandths."""
    b = v.box(spark, sf_dir).withColumn("area", F.col("w") * F.col("h")).withColumn("round", F.floor(1000 * F.least("w", "h") / F.greatest("w", "h")))
    ok = b.where((F.col("area") >= 500) & (F.col("round") > 700) & F.greatest("w", "h").between(150, 260))
    confidence = F.floor(F.least(F.floor(F.col("area") * 1000 / 60000), F.lit(1000)) * F.col("round") / 1000)
    return ok.groupBy("screen").agg(F.max(F.struct(confidence.alias("c"), (-F.col("ord")).alias("o"), (-F.col("x")).alias("x"))).alias("b"), F.count("*").alias("candidates")).select(
        "screen", F.col("b.c").alias("confidence"), (-F.col("b.o")).alias("ord"), "candidates"
    )


BEST_BUTTON = f"""WITH {v.BOX}, a AS (SELECT *, w * h AS area, floor(1000.0 * least(w, h) / greatest(w, h))::BIGINT AS r FROM v_box),
c AS (SELECT screen, ord, x, floor(least((area * 1000) // 60000, 1000) * r / 1000.0)::BIGINT AS confidence FROM a WHERE area >= 500 AND r > 700 AND greatest(w, h) BETWEEN 150 AND 260)
SELECT screen, max(confidence) AS confidence, first(ord ORDER BY confidence DESC, ord, x) AS ord, count(*) AS candidates FROM c GROUP BY screen"""


def ocr_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Fields by line: the first euro price, the first other line of more than three characters, the first weight."""
    lines = F.transform(F.split(F.replace(F.col("text"), F.lit(" | "), F.lit("\n")), "\n"), t.strip)
    priced = F.filter(lines, lambda x: x.rlike(r"\d+[.,]\d{2}\s*€"))
    named = F.filter(lines, lambda x: ~F.contains(x, F.lit("€")) & (F.char_length(x) > 3))
    weighed = F.filter(lines, lambda x: F.lower(x).rlike(t.WEIGHT))
    return v.ocr(spark, sf_dir).select(
        "product_id", F.regexp_extract(F.coalesce(F.try_element_at(priced, F.lit(1)), F.lit("")), r"\d+[.,]\d{2}", 0).alias("price"),
        F.coalesce(F.try_element_at(named, F.lit(1)), F.lit("")).alias("name"), t.weight_in_text(F.coalesce(F.try_element_at(weighed, F.lit(1)), F.lit(""))).alias("weight"), F.size(lines).alias("lines"),
    )


_W = r"(\d+(?:[.,]\d+)?)\s*(kg|g|ml|l|stk|stück)"
OCR_LINES = rf"""WITH {v.OCR_SQL}, l AS (SELECT product_id, list_transform(string_split(text, ' | '), lambda x: trim(x)) AS lines FROM v_ocr),
f AS (SELECT *, coalesce(list_filter(lines, lambda x: regexp_matches(lower(x), '{_W}'))[1], '') AS wl FROM l)
SELECT product_id, regexp_extract(list_filter(lines, lambda x: regexp_matches(x, '\d+[.,]\d{{2}}\s*€'))[1], '\d+[.,]\d{{2}}') AS price,
  coalesce(list_filter(lines, lambda x: NOT contains(x, '€') AND length(x) > 3)[1], '') AS name, regexp_extract(lower(wl), '{_W}', 1) || regexp_extract(lower(wl), '{_W}', 2) AS weight, len(lines)::INT AS lines FROM f"""


def exclusive_pricing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Only the unit price that goes with the goods' unit stays; the brand goes from the name where a word is left."""
    o = v.ocr(spark, sf_dir)
    unit = t.unit(F.col("unit"))
    ppu = F.trim(F.split_part(F.split_part("text", F.lit("|"), F.lit(3)), F.lit(" / "), F.lit(1)))
    name = F.concat_ws(" ", "brand", "product_name")
    bare = t.strip(F.regexp_replace(name, F.concat(F.lit("(?iu)^"), F.regexp_replace("brand", r"([.!&'])", r"\\$1")), F.lit("")))
    return o.select(
        "product_id", F.when(unit == "kg", ppu).otherwise("").alias("per_kg"), F.when(unit == "l", ppu).otherwise("").alias("per_liter"),
        F.when(unit == "Stk", ppu).otherwise("").alias("per_piece"), F.when(bare == "", name).otherwise(bare).alias("name"), t.eur(F.col("price")).alias("price"),
    )


EXCLUSIVE_PRICING = f"""WITH {v.OCR_SQL}, u AS (SELECT product_id, product_name, price, CASE unit WHEN 'ml' THEN 'l' WHEN 'g' THEN 'kg' ELSE unit END AS unit, trim(split_part(split_part(text, '|', 3), ' / ', 1)) AS ppu FROM v_ocr)
SELECT product_id, CASE unit WHEN 'kg' THEN ppu ELSE '' END AS per_kg, CASE unit WHEN 'l' THEN ppu ELSE '' END AS per_liter, CASE unit WHEN 'Stk' THEN ppu ELSE '' END AS per_piece, product_name AS name, price FROM u"""


def brand_split(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line's brand: a known one that leads it, else its run of leading capitalised words (at most two)."""
    line = F.concat_ws(" ", "brand", "product_name", "weight")
    known = F.array(*[F.lit(b) for _, b in fixed.BRANDS])
    leads = F.filter(known, lambda b: F.lower(line).startswith(F.concat(F.lower(b), F.lit(" "))))
    longest = F.array_max(F.transform(leads, lambda b, i: F.struct(F.char_length(b).alias("n"), (-i).alias("i"), b.alias("b"))))["b"]
    words = F.slice(F.split(line, " "), 1, 2)
    # capitals run from the start: once a word is small, the rest is left
    run = F.aggregate(
        words, F.struct(F.lit("").alias("s"), F.lit(True).alias("on")),
        lambda a, w: F.when(a["on"] & w.rlike(r"^\p{Lu}"), F.struct(F.trim(F.concat_ws(" ", a["s"], w)).alias("s"), F.lit(True).alias("on"))).otherwise(F.struct(a["s"].alias("s"), F.lit(False).alias("on"))),
    )["s"]
    return v.grocery(spark, sf_dir).select("product_id", F.coalesce(longest, run).alias("brand"), longest.isNotNull().alias("known"))


def _brand_split_sql() -> str:
    q = lambda s: s.replace("'", "''")
    known = "[" + ", ".join(f"'{q(b)}'" for _, b in fixed.BRANDS) + "]"
    return rf"""WITH {v.GROCERY_SQL}, l AS (SELECT product_id, brand || ' ' || product_name || ' ' || weight AS line FROM v_grocery),
k AS (SELECT *, list_filter({known}, lambda b: starts_with(lower(line), lower(b) || ' ')) AS leads, string_split(line, ' ')[:2] AS ws FROM l)
SELECT product_id, CASE WHEN len(leads) > 0 THEN list_reduce(leads, lambda a, b: CASE WHEN length(b) > length(a) THEN b ELSE a END)
  WHEN NOT regexp_matches(ws[1], '^\p{{Lu}}') THEN '' WHEN regexp_matches(ws[2], '^\p{{Lu}}') THEN ws[1] || ' ' || ws[2] ELSE ws[1] END AS brand, len(leads) > 0 AS known FROM k"""


#: What follows the day in a capture's name.
ENDINGS = (" at 10.30.{s} Obst.png", " at 9.05.{s}.jpeg", "_{s} (Kopie) Käse & Wurst.webp", " um 10.30 Gemüse.png", " at 11.{s}.07 PM Brot-Backwaren__neu.PNG")
MIMES = (("image/png", "png"), ("image/jpeg", "jpg"), ("image/webp", "webp"))


def file_categories(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Time and last number of capture file names, category words in them, and the MIME type's extension."""
    two = lambda c: F.lpad(c.cast("string"), 2, "0")
    number = F.col("file_id")
    ending = F.element_at(F.array(*map(F.lit, ENDINGS)), (number % len(ENDINGS) + 1).cast("int"))
    name = F.concat(F.lit("Screenshot 2024-"), two(number % 12 + 1), F.replace(ending, F.lit("{s}"), two(number % 60)))
    r = v.registry(spark, sf_dir).withColumn("name", name)
    numbers = F.regexp_extract_all("name", F.lit(r"\d+"), 0)
    ext = F.create_map(*[F.lit(x) for kv in MIMES for x in kv])
    mime = F.element_at(F.array(*[F.lit(m) for m, _ in MIMES], F.lit("image/tiff")), (number % (len(MIMES) + 1) + 1).cast("int"))
    return r.select(
        "file_id", F.regexp_extract("name", r"at (\d+\.\d+\.\d+)", 1).alias("time"), F.when(F.size(numbers) >= 2, F.element_at(numbers, -1)).alias("last"),
        t.category(F.col("name")).alias("category"), t.file_name(F.col("name")).alias("safe"), F.coalesce(F.try_element_at(ext, mime), F.lit("bin")).alias("ext"),
    )


def _file_categories_sql() -> str:
    from larder.plans.stats import _category_sql

    endings = "[" + ", ".join(f"'{e}'" for e in ENDINGS) + "]"
    types = "[" + ", ".join(f"'{m}'" for m, _ in MIMES) + ", 'image/tiff']"
    return rf"""WITH {v.REGISTRY}, n AS (SELECT file_id, 'Screenshot 2024-' || lpad((file_id % 12 + 1)::VARCHAR, 2, '0') ||
  replace({endings}[(file_id % {len(ENDINGS)} + 1)::INT], '{{s}}', lpad((file_id % 60)::VARCHAR, 2, '0')) AS name, {types}[(file_id % {len(MIMES) + 1} + 1)::INT] AS mime FROM v_registry),
w AS (SELECT *, list_filter(string_split_regex(name, '[^0-9]+'), lambda x: x <> '') AS numbers, list_filter(string_split_regex(name, '[^A-Za-z0-9]+'), lambda x: x <> '') AS words FROM n)
SELECT file_id, CASE WHEN regexp_matches(name, ' at [0-9]+[.][0-9]+[.][0-9]') THEN regexp_extract(split_part(name, ' at ', 2), '^[0-9.]+[0-9]') ELSE '' END AS time,
  numbers[-1] AS last, {_category_sql('name')} AS category, substring(array_to_string(words, '_'), 1, 50) AS safe,
  CASE mime {' '.join(f"WHEN '{m}' THEN '{e}'" for m, e in MIMES)} ELSE 'bin' END AS ext FROM w"""


def enrichment_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A product's scores by images, services and offers, each capped, and its level."""
    p = v.product(spark, sf_dir)
    images = v.image(spark, sf_dir).groupBy("product_id").agg(F.count("*").alias("images"), F.countDistinct("source").alias("services"))
    g = p.join(images, "product_id", "left").select("product_id", "cents", F.coalesce("images", F.lit(0)).alias("images"), F.coalesce("services", F.lit(0)).alias("services"))
    dedup = 40 + F.when(F.col("images") > 0, F.least(F.lit(20), 5 * F.col("images")) + 30).otherwise(10) + 10
    whole = F.least(F.lit(100), F.floor(F.col("services") * 30 / 5) + 45 + F.least(F.lit(20), 5 * F.col("images")))
    api = F.least(F.lit(100), 10 + F.least(F.lit(60), 15 * F.col("images")))
    level = F.when(F.col("cents") % 100 >= 90, 90).when(F.col("cents") % 100 >= 60, 60).when(F.col("cents") % 100 >= 25, 25).otherwise(0) + F.when(F.col("images") > 30, 15).otherwise(0)
    return g.select("product_id", dedup.cast("bigint").alias("dedup"), whole.cast("bigint").alias("whole"), api.cast("bigint").alias("api"), level.alias("level"), (level >= 75).alias("complete"))


ENRICHMENT_SCORES = f"""WITH {v.PRODUCT}, {v.IMAGE}, i AS (SELECT product_id, count(*) AS images, count(DISTINCT source) AS services FROM v_image GROUP BY product_id),
g AS (SELECT product_id, cents, coalesce(images, 0) AS images, coalesce(services, 0) AS services FROM v_product LEFT JOIN i USING (product_id)),
l AS (SELECT *, CASE WHEN cents % 100 >= 90 THEN 90 WHEN cents % 100 >= 60 THEN 60 WHEN cents % 100 >= 25 THEN 25 ELSE 0 END + CASE WHEN images > 30 THEN 15 ELSE 0 END AS level FROM g)
SELECT product_id, (40 + CASE WHEN images > 0 THEN least(20, 5 * images) + 30 ELSE 10 END + 10)::BIGINT AS dedup, least(100, services * 30 // 5 + 45 + least(20, 5 * images))::BIGINT AS whole,
  least(100, 10 + least(60, 15 * images))::BIGINT AS api, level, level >= 75 AS complete FROM l"""


def image_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Weighted image quality of measured shares (in percent), its tier, and how many are acceptable."""
    b = v.box(spark, sf_dir)
    edge, transparent, colour, artifact = F.col("x") % 101, F.col("y") % 101, F.col("w") % 101, F.col("h") % 101
    share = F.col("x") % 100
    complete = F.when(share.between(30, 80), 100).when(share < 10, 20).when(share > 95, 10).otherwise(60)
    score = F.floor((25 * edge + 20 * transparent + 20 * colour + 15 * artifact + 20 * complete) / 100)
    tier = F.lit("poor")
    for least, name in reversed(fixed.QUALITY_TIERS):
        tier = F.when(F.col("score") >= least, name).otherwise(tier)
    scored = b.withColumn("score", score).withColumn("tier", tier)
    return scored.groupBy("tier").agg(F.count("*").alias("images"), F.count_if(F.col("score") >= 60).alias("acceptable"), F.sum("score").alias("total"))


IMAGE_QUALITY = f"""WITH {v.BOX}, s AS (SELECT (25 * (x % 101) + 20 * (y % 101) + 20 * (w % 101) + 15 * (h % 101) + 20 * CASE WHEN x % 100 BETWEEN 30 AND 80 THEN 100 WHEN x % 100 < 10 THEN 20 WHEN x % 100 > 95 THEN 10 ELSE 60 END) // 100 AS score FROM v_box)
SELECT CASE WHEN score >= 90 THEN 'excellent' WHEN score >= 75 THEN 'good' WHEN score >= 60 THEN 'acceptable' WHEN score >= 40 THEN 'fair' ELSE 'poor' END AS tier,
  count(*) AS images, count(*) FILTER (WHERE score >= 60) AS acceptable, sum(score)::BIGINT AS total FROM s GROUP BY tier"""


def longest_answer(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The longest answer of more than five characters in each conversation, the first of equals."""
    log = v.read(spark, sf_dir, "conversations").where((F.col("role") == "assistant") & (F.char_length("text") > 5))
    best = F.max(F.struct(F.char_length("text").alias("n"), (-F.col("turn")).alias("t")))
    return log.groupBy("conv_id").agg(best.alias("b"), F.count("*").alias("answers")).select("conv_id", F.col("b.n").alias("chars"), (-F.col("b.t")).alias("turn"), "answers")


LONGEST_ANSWER = """SELECT conv_id, max(length(text))::INT AS chars, first(turn ORDER BY length(text) DESC, turn) AS turn, count(*) AS answers
FROM conversations WHERE role = 'assistant' AND length(text) > 5 GROUP BY conv_id"""


def submit_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pending requests: done at once where the worker completed one before, else queued; one row a state and priority.

    The table has no priorities, so ids give them in turn: 1 is high, 3 is low.
    """
    r = v.registry(spark, sf_dir)
    cached = r.where("status = 'completed'").groupBy("worker").agg(F.min("started_at").alias("since"))
    asked = r.where("status = 'pending'").join(cached, "worker", "left")
    state = F.when(F.col("since") < F.col("started_at"), "completed").otherwise("queued")
    return asked.select("file_id", state.alias("state"), (F.col("file_id") % 3 + 1).cast("int").alias("priority")).groupBy("state", "priority").agg(
        F.count("*").alias("requests"), F.min("file_id").alias("first")
    )


SUBMIT_REQUESTS = f"""WITH {v.REGISTRY}, a AS (SELECT file_id, EXISTS (FROM v_registry c WHERE c.worker = r.worker AND c.status = 'completed' AND c.started_at < r.started_at) AS hit
  FROM v_registry r WHERE status = 'pending')
SELECT CASE WHEN hit THEN 'completed' ELSE 'queued' END AS state, (file_id % 3 + 1)::INT AS priority, count(*) AS requests, min(file_id) AS first FROM a GROUP BY ALL"""


#: How answers are cut off; {n} is a number and {k} a field of the log.
CUTS = ('{"name": "n{n}", "k": {k}, "brand": "Re', '{"name": "n{n}, extra", "k": {k}, "brand": "Rewe"}', '{"name": "a {b} c", "k": {k}, "brand": "', '{"brand": "B{n}", "k": {k}, "name": "Apf')


def repaired_json(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Cut-off JSON answers: the unfinished field goes, the brace is closed, missing fields get defaults."""
    cut = F.element_at(F.array(*map(F.lit, CUTS)), (F.col("file_id") % len(CUTS) + 1).cast("int"))
    cut = F.replace(F.replace(cut, F.lit("{n}"), F.col("file_id").cast("string")), F.lit("{k}"), F.get_json_object("props", "$.k"))
    whole = F.regexp_replace(cut, r',\s*"\w+":\s*"[^"]*$', "")
    read = F.from_json(F.when(whole.endswith("}"), whole).otherwise(F.concat(whole, F.lit("}"))), "name string, k bigint, brand string")
    blank = lambda c: F.coalesce(read[c], F.lit("")).alias(c)
    return v.registry(spark, sf_dir).select("file_id", blank("name"), read["k"].alias("k"), blank("brand"))


_CUTS = "[" + ", ".join(f"'{c}'" for c in CUTS) + "]"
# a field counts if its closing quote is there
REPAIRED_JSON = rf"""WITH {v.REGISTRY}, c AS (SELECT file_id, replace(replace({_CUTS}[(file_id % {len(CUTS)} + 1)::INT], '{{n}}', file_id::VARCHAR), '{{k}}', json_extract_string(props, '$.k')) AS cut FROM v_registry)
SELECT file_id, regexp_extract(cut, '"name": "([^"]*)"', 1) AS name, regexp_extract(cut, '"k": ([0-9]+)', 1)::BIGINT AS k, regexp_extract(cut, '"brand": "([^"]*)"', 1) AS brand FROM c"""


def extraction_rates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Jobs by the share of their files that is done, with the running number of jobs."""
    j = v.job(spark, sf_dir)
    per = j.groupBy("job_id").agg(F.count("*").alias("found"), F.count_if(F.col("status") == "completed").alias("taken"))
    rate = F.when(F.col("found") == 0, 0).otherwise(F.floor(100 * F.col("taken") / F.col("found")))
    bucket = per.withColumn("rate", rate).groupBy("rate").agg(F.count("*").alias("jobs"), F.sum("found").alias("files"))
    upto = Window.orderBy("rate").rowsBetween(Window.unboundedPreceding, 0)  # at most 101 rates
    return bucket.withColumn("jobs_upto", F.sum("jobs").over(upto))


EXTRACTION_RATES = f"""WITH {v.JOB}, p AS (SELECT job_id, count(*) AS found, count(*) FILTER (WHERE status = 'completed') AS taken FROM v_job GROUP BY job_id),
b AS (SELECT floor(100.0 * taken / found)::BIGINT AS rate, count(*) AS jobs, sum(found)::BIGINT AS files FROM p GROUP BY rate)
SELECT *, (sum(jobs) OVER (ORDER BY rate))::BIGINT AS jobs_upto FROM b"""

def descriptions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Free text read as brand and name: the first known brand in title case, taken out of the name."""
    text = F.lower(F.concat_ws(" ", "product_name", F.lit("von"), "brand"))
    found = F.try_element_at(F.filter(F.array(*[F.lit(b) for b in fixed.DESCRIPTION_BRANDS]), lambda b: F.contains(text, b)), F.lit(1))
    name = F.when(found.isNull(), text).otherwise(F.trim(F.regexp_replace(F.replace(text, found, F.lit("")), " +", " ")))
    return v.grocery(spark, sf_dir).select("product_id", F.initcap(F.coalesce(found, F.lit("generic"))).alias("brand"), name.alias("name"))


def _descriptions_sql() -> str:
    text = "lower(product_name || ' von ' || brand)"
    hits = [f"contains({text}, '{b}')" for b in fixed.DESCRIPTION_BRANDS]
    pick = lambda f: "CASE " + " ".join(f"WHEN {h} THEN {f(b)}" for h, b in zip(hits, fixed.DESCRIPTION_BRANDS))
    title = pick(lambda b: f"'{b.title()}'") + " ELSE 'Generic' END"
    name = pick(lambda b: f"trim(regexp_replace(replace({text}, '{b}', ''), ' +', ' ', 'g'))") + f" ELSE {text} END"
    return f"WITH {v.GROCERY_SQL} SELECT product_id, {title} AS brand, {name} AS name FROM v_grocery"


def header_regions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A screen's subcategory from its text regions: regions with a keyword in the upper part, meat first, then the largest."""
    words = F.array(*[F.lit(w) for w in fixed.HEADER_WORDS])
    b = v.box(spark, sf_dir).withColumn("word", F.element_at(words, (F.col("x") % len(fixed.HEADER_WORDS) + 1).cast("int")))
    upper = b.where((F.col("y") < 630) & (F.col("w") * F.col("h") > 25000))
    best = F.max(F.struct(F.col("word").isin(*fixed.MEAT_WORDS).alias("meat"), (F.col("w") * F.col("h")).alias("area"), (-F.col("y")).alias("y"), "word"))
    return upper.groupBy("screen").agg(best.alias("b"), F.count("*").alias("regions")).select("screen", F.col("b.word").alias("word"), F.col("b.meat").alias("meat"), "regions")


_WORDS = "[" + ", ".join(f"'{w}'" for w in fixed.HEADER_WORDS) + "]"
_MEAT = ", ".join(f"'{w}'" for w in fixed.MEAT_WORDS)
HEADER_REGIONS = f"""WITH {v.BOX}, w AS (SELECT *, {_WORDS}[(x % {len(fixed.HEADER_WORDS)} + 1)::INT] AS word, w * h AS area FROM v_box WHERE y < 630 AND w * h > 25000)
SELECT screen, first(word ORDER BY word IN ({_MEAT}) DESC, area DESC, y, word DESC) AS word, bool_or(word IN ({_MEAT})) AS meat, count(*) AS regions FROM w GROUP BY screen"""


def phrasing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What to tell a user about a product's matches: none, one that is sure enough, or a list to choose from."""
    names = v.product(spark, sf_dir).select("product_id", "product_name", "brand")
    per = names.groupBy("product_name").agg(F.count("*").alias("n"), F.array_sort(F.collect_set("brand")).alias("brands"))
    sure = F.floor(100 / F.col("n"))
    line = (
        F.when((F.col("n") == 1) & (sure > 90), F.concat(F.lit("Is it "), F.col("product_name"), F.lit(" by "), F.col("brands")[0], F.lit("?")))
        .otherwise(F.concat(F.col("n").cast("string"), F.lit(" products match. Brands: "), F.array_join(F.slice("brands", 1, 3), ", ")))
    )
    return per.select("product_name", "n", line.alias("line"))


PHRASING = f"""WITH {v.PRODUCT}, p AS (SELECT product_name, count(*) AS n, list_sort(list(DISTINCT brand)) AS brands FROM v_product GROUP BY product_name)
SELECT product_name, n, CASE WHEN n = 1 THEN 'Is it ' || product_name || ' by ' || brands[1] || '?' ELSE n || ' products match. Brands: ' || array_to_string(brands[:3], ', ') END AS line FROM p"""

QUERIES = {
    "header_check": (header_check, HEADER_CHECK),
    "best_button": (best_button, BEST_BUTTON),
    "ocr_lines": (ocr_lines, OCR_LINES),
    "exclusive_pricing": (exclusive_pricing, EXCLUSIVE_PRICING),
    "brand_split": (brand_split, _brand_split_sql()),
    "file_categories": (file_categories, _file_categories_sql()),
    "enrichment_scores": (enrichment_scores, ENRICHMENT_SCORES),
    "image_quality": (image_quality, IMAGE_QUALITY),
    "longest_answer": (longest_answer, LONGEST_ANSWER),
    "submit_requests": (submit_requests, SUBMIT_REQUESTS),
    "repaired_json": (repaired_json, REPAIRED_JSON),
    "extraction_rates": (extraction_rates, EXTRACTION_RATES),
    "descriptions": (descriptions, _descriptions_sql()),
    "header_regions": (header_regions, HEADER_REGIONS),
    "phrasing": (phrasing, PHRASING),
}
