"""URL filter: explicit rules first, then logistic regression on hashed character n-grams."""

from __future__ import annotations

import string

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailpulse.llm.common import stored

#: (host, path, verdict) of the contract; fixed values.
RULES = [
    ("com", "/", "allow"),
    ("example.com", "/en/", "block"),
    ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"),
    ("net", "/fr/", "block"),
]
# A small labelled URL table, whole hosts and paths. Among the wanted ones
# are hosts that merely contain what unwanted ones are made of.
BLOCKED = """
ads-track.example.com/en/10  track.ads-server.example.net/click/77  popads.example.org/de/4/  click-tracker.net/c/1881  banner-ads.com/show
ad-clicks.example.com/fr/20  best-adserver.net/imp/9  trk-clicks.info/r/55  adult-x.example.com/de/12  www.adult-cams.net/en/live
xxx-videos.example.net/es/40  m.xxx-tube.com/watch/9  hot-adult-dating.org/join  free-sex-cams.net/  blog.sex-chat.example.org/fr/3
porn-hd.example.com/en/18  m.porn-clips.net/v/3  escort-girls.example.net/city/5  cheap-pills.example.com/en/19  buy-cheap-pills.net/order/2
pills-online.example.org/de/31.html  viagra-online.net/buy  www.cheap-viagra.example.com/fr/11  pharma-discount.net/cart/7  no-prescription-pills.com/
casino-win.example.com/en/14  www.online-casino.net/bonus/50  casino-bonus.example.org/es/9/  win-big-casino.com/play  m.casino-spins.example.net/de/22
free-bets.example.com/fr/8.html  best-bets-online.net/today  sports-bets.example.org/en/30  free-bets-bonus.com/claim/4  poker-win.example.net/de/7
online-poker-cash.com/table/2  jackpot-slots.example.com/en/5  www.win-jackpot.net/spin  free-spins-slots.org/  spam-farm.example.com/en/13
link-farm.example.net/page/1001  seo-spam.example.org/de/17  blog.spam-links.net/a/2  cheap-backlinks.com/buy/100  buy-followers.net/cheap
payday-loan.example.com/apply  fast-cash-loans.net/en/1  cheap-loan-online.org/  quick-cash-now.com/win  free-iphone-win.net/claim
win-prize-now.example.com/en/2  you-win-free.org/prize/1  replica-watches.example.net/fr/6  cheap-replica-bags.com/sale/3  www.replica-shop.net/
warez-downloads.example.com/de/9  free-warez.net/file/77  crack-serial.example.org/en/4  keygen-crack.com/dl/3  torrent-free-movies.net/get/1
malware-host.example.com/x/1  phish-login.example.net/verify  free-crypto-win.com/claim  m.hot-singles.example.org/es/2  lose-weight-pills.com/buy/1
""".split()
WANTED = """
tionsh.example.net/de/101/  blog.lorem.example.com/en/1012  m.dolore.example.com/de/11282  www.amet.example.org/fr/317.html  ththan.example.net/de/10306
m.consec.example.org/es/209  blog.tempor.example.net/en/450/  incid.example.com/fr/8  www.labore.example.net/de/22/  m.therin.example.org/en/70.html
onder.example.org/fr/9  blog.thonth.example.com/es/12  stethe.example.net/en/3  www.errand.example.com/de/5  m.anther.example.net/fr/6/
library.example.org/en/10  www.city-library.org/books/4  museum.example.com/de/7  natural-history-museum.org/visit  school.example.net/fr/19
www.village-school.org/news/2  weather.example.com/en/today  garden-recipes.example.org/es/3  history.example.net/de/1066.html  science-journal.org/issue/12
physics-letters.example.com/vol/8  www.town-council.gov/meetings  archive.example.org/item/1999  travel-notes.example.com/en/paris  music-theatre.example.net/de/5
railway-timetable.org/line/4  forest-service.gov/maps/9  harbour-market.example.com/fr/2  news.example.com/en/2024/  blog.cooking.example.org/soup
docs.example.com/guide/start  wiki.example.org/page/Main  forum.example.net/topic/55  open-data.example.gov/table/3  university.edu/courses/12
essex.gov/en/10  www.sussex.ac.uk/study  middlesex-hospital.org/visit  roads.example.com/map/2  broads-authority.gov.uk/boating
downloads.example.org/release/4  loads-and-beams.edu/notes/1  adsorption-journal.org/issue/3  salads.example.net/recipes/7  threads.example.com/en/81
loans.gov/students  student-loans.example.gov/repay  library-loans.org/return  pharmacology.edu/lecture/2  hospital-pharmacy.example.org/hours
track-and-field.example.com/results  racetrack-history.org/1932  soundtrack.example.net/album/6  adult-education.example.org/courses  adult-literacy.gov/help
winter-sports.example.com/en/4  windsor.example.org/castle  betsy-ross.example.net/flag  alphabets.example.org/greek  tibet-studies.edu/texts/1
spamalot-theatre.example.com/tickets  farm-museum.example.org/visit  wind-farm.example.net/de/3  firecracker-history.org/  biscuit-cracker.example.com/bake
clickbeetle-survey.org/species/4  popular-science.example.com/en/9  freedom.example.org/speech  freeman-library.example.net/fr/1  cheapside-london.example.com/walk
videos-for-schools.example.org/maths  pokerwork-crafts.example.net/wood  crossword-jackdaw.org/  singles-chart.example.com/1984  caterpillars.example.org/guide
""".split()
GRAM = 3
FEATURES = 1 << 14
#: Most rows the regression is fitted on, the lowest hashes first.
TRAINING_ROWS = 4000


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty for null and without ``://``."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    host = F.regexp_extract(rest, r"^[^/?#]*", 0)
    path = F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)
    return F.translate(host, string.ascii_uppercase, string.ascii_lowercase), path


def matching_rule(host: Column, path: Column, rules: list[tuple[str, str, str]]) -> Column:
    """Struct (length, rule, verdict) of the longest rule that fits, else null; ties go to the larger text."""
    def fitting(name, prefix, verdict):
        fits = ((host == name) | host.endswith(f".{name}")) & path.startswith(prefix)
        value = F.struct(
            F.lit(len(name + prefix)).alias("length"), F.lit(name + prefix).alias("rule"), F.lit(verdict).alias("verdict")
        )
        return F.when(fits, value)

    if not rules:
        return F.lit(None).cast("struct<length:int,rule:string,verdict:string>")
    found = [fitting(*r) for r in rules]
    return found[0] if len(found) == 1 else F.greatest(*found)


def _grams(text: Column, mark: str) -> Column:
    padded = F.concat(F.lit("^"), text, F.lit("$"))
    starts = F.sequence(F.lit(1), F.greatest(F.length(padded) - GRAM + 1, F.lit(1)))
    return F.transform(starts, lambda i: F.concat(F.lit(mark), F.substring(padded, i, F.lit(GRAM))))


def grams(host: Column, path: Column) -> Column:
    """Character n-grams of host and path with their ends marked, kept apart by a prefix."""
    return F.concat(_grams(host, "h:"), _grams(path, "p:"))


def hashed(df: DataFrame, features: int) -> DataFrame:
    """``df`` (host, path) with the vector column ``features``."""
    named = df.withColumn("grams", grams(F.col("host"), F.col("path")))
    return HashingTF(numFeatures=features, binary=True, inputCol="grams", outputCol="features").transform(named)


def labelled_urls(spark: SparkSession) -> DataFrame:
    """(host, path, verdict) of the labelled addresses above."""
    rows = [(*url.partition("/"), verdict) for urls, verdict in ((BLOCKED, "block"), (WANTED, "allow")) for url in urls]
    values = ", ".join(f"('{host}', '{slash}{path}', '{verdict}')" for host, slash, path, verdict in rows)
    return spark.sql(f"SELECT * FROM VALUES {values} AS t(host, path, verdict)")


def fit(labelled: DataFrame, features: int = FEATURES, training_rows: int = TRAINING_ROWS):
    """Model of a labelled URL table (host, path, verdict), or the verdict to give to all.

    Of the distinct rows at most ``training_rows`` are used, those of lowest hash. A
    table with one verdict only gives that verdict, an empty one gives ``allow``.
    """
    order = [F.xxhash64("host", "path"), "host", "path", "verdict"]
    chosen = labelled.select("host", "path", "verdict").distinct().orderBy(*order).limit(training_rows)
    chosen = stored(chosen.coalesce(1))
    counts = {r["verdict"]: r["count"] for r in chosen.groupBy("verdict").count().collect()}
    if len(counts) < 2:
        return min(counts, default="allow")
    rows = hashed(chosen, features).withColumn("label", (F.col("verdict") == "block").cast("double"))
    # Both verdicts weigh the same, whatever their share of the table.
    rows = rows.withColumn("weight", F.when(F.col("label") == 1, 0.5 / counts["block"]).otherwise(0.5 / counts["allow"]))
    solver = LogisticRegression(maxIter=60, regParam=0.02, tol=1e-8, weightCol="weight")
    return solver.fit(rows.select("features", "label", "weight"))


def judge(
    pages: DataFrame,
    rules: list[tuple[str, str, str]] = RULES,
    labelled: DataFrame | None = None,
    features: int = FEATURES,
    training_rows: int = TRAINING_ROWS,
) -> DataFrame:
    """(page_id, host, path, rule, verdict, score) of every row of ``pages`` (page_id, url, anything else).

    A rule fits its host and all subdomains if the path starts with the rule's; the
    longest wins. Other urls get the verdict of the regression: ``block`` if the
    probability ``score`` of being blocked is at least 0.5. ``labelled`` (host, path,
    verdict) trains it, by default the small table of this module; the judged pages
    teach it nothing, so a url's verdict does not depend on the others. Null urls and
    those without ``://`` have empty host and path and are judged by the regression
    like any other; repeated rows are judged alike; an empty table gives an empty one.
    """
    host, path = host_and_path(F.col("url"))
    parts = pages.select(F.col("page_id").cast("long").alias("page_id"), host.alias("host"), path.alias("path"))
    parts = parts.withColumn("found", matching_rule(F.col("host"), F.col("path"), rules))
    model = fit(labelled_urls(pages.sparkSession) if labelled is None else labelled, features, training_rows)
    if isinstance(model, str):
        scored = parts.withColumn("score", F.lit(float(model == "block")))
    else:
        scored = model.transform(hashed(parts, features))
        scored = scored.withColumn("score", vector_to_array("probability")[1])
    guess = F.when(F.col("score") >= 0.5, "block").otherwise("allow")
    return scored.select(
        "page_id", "host", "path", F.col("found.rule").alias("rule"),
        F.coalesce(F.col("found.verdict"), guess).alias("verdict"), "score",
    )
