"""URL filters (operator 13), in DataFrame functions only: host rules first, then logistic regression on hashed character n-grams of host and path."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizer
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Fits ``host`` and all its subdomains where the path starts with ``path``."""

    host: str
    path: str
    verdict: str

    @property
    def name(self) -> str:
        return self.host + self.path


#: The rules of the query.
RULES = (Rule("org", "/", "allow"), Rule("example.org", "/es/", "block"), Rule("example.org", "/en/1", "block"), Rule("com", "/fr/", "allow"), Rule("com", "/de/", "block"))

#: The small table of labelled addresses; 1 is to be blocked.
LABELLED = (
    ("https://www.city-library.example.edu/opening-hours", 0), ("https://news.daily-herald.example.com/world/2023/11/04/summit", 0), ("http://docs.python-guide.example.org/tutorial/strings.html", 0), ("https://en.encyclopedia.example.org/wiki/Photosynthesis", 0),
    ("https://blog.garden-notes.example.net/en/2021/tomatoes", 0), ("https://m.weather-service.example.com/forecast/berlin", 0), ("https://museum.example.org/exhibitions/bronze-age", 0), ("http://physics.university.example.edu/courses/101/syllabus", 0),
    ("https://recipes.kitchen-table.example.com/soup/leek-potato", 0), ("https://www.town-council.example.org/minutes/march", 0), ("https://forum.astronomy-club.example.net/threads/telescope-mirror", 0), ("https://shop.bookstore.example.com/fiction/novels", 0),
    ("https://journals.medical-review.example.org/articles/cardiology", 0), ("https://www.railway-timetable.example.com/stations/north", 0), ("https://archive.historic-letters.example.org/1912/july", 0), ("http://www.primary-school.example.edu/teachers/contact", 0),
    ("https://blog.software-design.example.com/2019/refactoring.html", 0), ("https://travel.mountain-huts.example.net/fr/alpes", 0), ("https://www.cinema-guide.example.com/reviews/drama", 0), ("https://support.printer-maker.example.com/manuals/model-7", 0),
    ("https://theatre.example.org/season/autumn", 0), ("https://m.football-results.example.com/league/table", 0), ("https://www.health-ministry.example.org/vaccination", 0), ("https://language-course.example.net/de/grammatik", 0),
    ("https://www.river-trust.example.org/en/fishing/permits", 0), ("https://data.statistics-office.example.org/census/2011", 0), ("https://music.choir-association.example.net/concerts", 0), ("https://www.hospital-trust.example.org/departments/heart", 0),
    ("https://blog.thirteen-threads.example.com/en/214", 0), ("https://notes.the-other-thing.example.net/es/77", 0), ("https://weekly.nation-and-station.example.org/en/311.html", 0), ("https://www.thoughtful-tension.example.com/en/96#top", 0),
    ("https://www.bicycle-repair.example.net/en/404/", 0), ("https://blog.chess-openings.example.com/en/12?page=2", 0), ("https://m.parents-evening.example.org/de/58", 0), ("https://www.paper-mill.example.com/fr/640?utm_source=feed", 0),
    ("http://m.harbour-news.example.net/en/88", 0), ("http://blog.winter-coats.example.net/en/31", 0), ("https://wool-and-thread.example.com/es/5", 0), ("https://m.town-band.example.com/en/9", 0), ("http://lighthouse.example.net/en/1", 0),
    ("https://www.northern-path.example.net/de/17", 0), ("https://blog.there-and-then.example.net/fr/12", 0), ("http://hither.example.com/en/700", 0), ("https://m.another-day.example.net/en/250?page=2&ref=x", 0), ("http://www.gardener.example.net/en/3", 0),
    ("https://father-and-son.example.com/en/868", 0), ("http://rather.example.net/es/41.html", 0), ("https://www.method-and-thesis.example.com/es/960", 0), ("http://blog.motion-station.example.net/en/533/", 0), ("https://thirty-third.example.com/en/85", 0),
    ("https://m.brother-bear.example.net/fr/27", 0), ("https://leather-goods.example.net/en/369#top", 0), ("http://www.weather-vane.example.com/en/676", 0), ("https://gathering.example.net/en/770", 0), ("http://m.earthen-pots.example.net/de/474.html", 0),
    ("https://blog.nothing-new.example.com/en/853/", 0), ("http://smith-and-smith.example.net/en/148", 0), ("https://www.mountain-air.example.net/es/978", 0), ("https://blog.table-talk.example.com/es/621", 0), ("http://www.tea-house.example.net/en/42", 0),
    ("https://m.violin-school.example.com/es/303", 0), ("https://bakery.example.net/fr/90?utm_source=feed", 0), ("https://www.ship-models.example.com/en/555", 0),
    ("http://www.online-casino.example.com/jackpot/free-spins", 1), ("https://casino-bonus.example.net/win/big-prize", 1), ("http://best-slots-win.example.com/en/poker", 1), ("https://free-bets-today.example.com/football/betting-odds", 1),
    ("http://bet-and-win.example.net/de/free-bet", 1), ("https://m.poker-win-cash.example.com/en/88", 1), ("http://cheap-viagra.example.com/buy-pills-online", 1), ("https://discount-pills.example.net/cheap/no-prescription", 1),
    ("http://www.cheap-meds-pharmacy.example.com/pills", 1), ("https://blog.diet-pills-cheap.example.com/en/31", 1), ("http://spam-links.example.com/out?id=9", 1), ("https://link-farm.example.net/en/1", 1),
    ("http://www.spam-network.example.com/farm/77", 1), ("https://content-farm-spam.example.com/es/5", 1), ("http://ads-server.example.com/track/click?id=4", 1), ("https://m.track-ads.example.net/banner/77", 1),
    ("http://adserver-tracking.example.com/pixel.gif", 1), ("https://www.pop-ads-tracker.example.com/en/9", 1), ("http://adult-video.example.com/xxx/1", 1), ("https://xxx-adult-cams.example.net/live", 1),
    ("http://www.adult-dating-x.example.com/en/sexy", 1), ("https://blog.hot-adult-pics.example.com/en/3", 1), ("http://free-money-now.example.com/winner/claim-prize", 1), ("https://get-rich-quick.example.net/en/win-cash", 1),
    ("http://replica-watches-cheap.example.com/rolex", 1), ("https://www.payday-loans-fast.example.com/apply-now", 1), ("http://cracked-software.example.net/warez/keygen", 1), ("https://torrent-warez.example.com/free-download", 1),
    ("http://casino-royal-win.example.org/en/slots", 1), ("https://free-casino-bets.example.com/en/700", 1), ("http://www.cheap-cheap-pills.example.net/fr/12", 1), ("https://ads-click-track.example.com/en/250?page=2&ref=x", 1),
    ("http://play-casino-online.example.net/en/9", 1), ("https://slots-and-poker.example.com/bonus", 1), ("http://online-betting.example.net/odds/today", 1), ("https://sports-bets.example.com/en/41", 1), ("http://m.jackpot-casino.example.net/spin", 1),
    ("http://buy-cheap-meds.example.net/en/7", 1), ("https://online-pharmacy-pills.example.com/viagra", 1), ("http://cheap-loans.example.net/apply", 1), ("https://fast-payday-cash.example.com/en/66", 1), ("http://blog.weight-loss-pills.example.net/es/3", 1),
    ("http://free-spam.example.net/en/14", 1), ("https://seo-links-farm.example.com/backlinks", 1), ("http://www.link-spam-farm.example.net/out", 1), ("https://click-farm.example.com/fr/8", 1), ("http://ads-network.example.net/click", 1),
    ("https://banner-ads.example.com/track", 1), ("http://m.tracking-pixel.example.net/ads", 1), ("https://ad-track-click.example.net/en/27", 1), ("http://adult-chat.example.net/cams", 1), ("https://www.xxx-videos.example.com/adult/free", 1),
    ("http://sexy-dating.example.net/en/5", 1), ("https://hot-xxx-cams.example.com/live", 1), ("http://win-free-prize.example.net/claim", 1), ("https://cash-prize-winner.example.com/en/19", 1), ("http://free-bet-bonus.example.com/win", 1),
    ("https://cheap-replica-bags.example.net/de/2", 1), ("http://warez-cracks.example.com/keygen", 1), ("https://free-torrent-download.example.net/en/6", 1), ("http://casino-poker-bets.example.net/es/4", 1), ("https://cheap-rolex-replica.example.com/en/11", 1),
    ("no address", 1), ("", 1), ("://", 1), ("mailto", 1),
)

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host, after the first ``://`` up to a slash, question mark, hash or the end, with A-Z lower-cased, and path from there up to a question mark, hash or the end; both
    empty without ``://`` or of null."""
    rest = F.when(F.contains(url, F.lit("://")), F.substring(url, F.locate("://", url) + 3, F.length(url)))
    part = lambda pattern: F.coalesce(F.regexp_extract(rest, pattern, 1), F.lit(""))
    return F.translate(part("^([^/?#]*)"), UPPER, LOWER), part("^[^/?#]*([^?#]*)")


def rule_of(host: Column, path: Column, rules: tuple[Rule, ...]) -> Column:
    """(rule, verdict) of the longest rule that fits, or null; of rules as long, the first in order of their names."""
    out = F.when(F.lit(False), F.struct(F.lit("").alias("rule"), F.lit("").alias("verdict")))
    for r in sorted(rules, key=lambda r: (-len(r.name), r.name)):
        fits = ((host == r.host) | F.endswith(host, F.lit("." + r.host))) & F.startswith(path, F.lit(r.path))
        out = out.when(fits, F.struct(F.lit(r.name).alias("rule"), F.lit(r.verdict).alias("verdict")))
    return out


def grams(host: Column, path: Column, lengths: tuple[int, ...] = (3, 4, 5)) -> Column:
    """The distinct n-grams of characters of the host, and those of the path with a mark before them; the ends of each count as characters."""

    def rolling(chars: Column, mark: str, n: int) -> Column:
        starts = F.slice(chars, F.lit(1), F.greatest(F.size(chars) - (n - 1), F.lit(0)))
        return F.transform(starts, lambda c, i: F.concat(F.lit(mark), c, *[F.get(chars, i + j) for j in range(1, n)]))

    def of(text: Column, mark: str) -> Column:
        # A transform over an array of one names the characters: else they'd be split again for every n-gram.
        named = F.array(F.split(F.concat(F.lit("^"), text, F.lit("$")), ""))
        return F.flatten(F.transform(named, lambda chars: F.concat(*[rolling(chars, mark, n) for n in lengths])))

    return F.array_distinct(F.concat(of(host, ""), of(F.translate(path, UPPER, LOWER), "/:")))


def labelled_urls(spark: SparkSession, rows: tuple[tuple[str, int], ...] = LABELLED) -> DataFrame:
    """(url, block) of the small table, without a Python worker."""
    return spark.range(1).select(F.inline(F.array(*[F.struct(F.lit(u).alias("url"), F.lit(float(b)).alias("block")) for u, b in rows])))


def _buckets(words: Column, n: int) -> Column:
    """The distinct numbers below n that the words hash to."""
    return F.array_distinct(F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(n)).cast("int")))


@dataclass(frozen=True)
class Model:
    """Logistic regression over hashed n-grams: a weight for each bucket."""

    weights: tuple[float, ...]
    intercept: float

    def chance(self, words: Column) -> Column:
        """The probability that ``words`` are to be blocked, in expressions of Spark alone: no fitted object goes to the tasks."""
        # One constant: the optimizer makes the array of the text once.
        weights = F.split(F.lit(",".join(map(repr, self.weights))), ",").cast("array<double>")
        total = F.aggregate(_buckets(words, len(self.weights)), F.lit(self.intercept), lambda a, b: a + F.get(weights, b))
        return 1 / (1 + F.exp(-total))


def fit(labelled: DataFrame, most_rows: int = 20_000, buckets: int = 1 << 16, penalty: float = 0.001) -> Model:
    """Logistic regression over n-grams hashed to ``buckets``, from at most ``most_rows`` rows of ``labelled`` (url, block 0 or 1), those first by hash.
    Rows without a label, and with a label of another kind, are left out; a null url is as an empty one.

    Only the weights are kept: a fitted object can hold the session, which can't go to the tasks."""
    host, path = host_and_path(F.coalesce(F.col("url"), F.lit("")))
    rows = labelled.where(F.col("block").isin(0, 1)).orderBy(F.xxhash64("url", "block"), "url", "block").limit(most_rows)
    rows = rows.select(_buckets(grams(host, path), buckets).cast("array<string>").alias("words"), F.col("block").cast("double").alias("label")).coalesce(1)
    counts = CountVectorizer(inputCol="words", outputCol="features", vocabSize=buckets, binary=True).fit(rows)
    model = LogisticRegression(regParam=penalty, maxIter=40, tol=1e-6, standardization=False).fit(counts.transform(rows))
    weights = [0.0] * buckets
    for bucket, weight in zip(counts.vocabulary, model.coefficients.toArray().tolist(), strict=True):
        weights[int(bucket)] = weight
    return Model(tuple(weights), float(model.intercept))


def url_filter(pages: DataFrame, labelled: DataFrame | None = None, rules: tuple[Rule, ...] = RULES, key: str = "page_id", url: str = "url", block_from: float = 0.5, model: Model | None = None) -> DataFrame:
    """One row per row of ``pages``: key, host, path, rule, verdict, score.

    The longest rule that fits decides (``rules`` is a short list, which becomes one expression); where none does, the model: block if its
    probability is at least ``block_from``. rule is null there, and score, that probability, is null where a rule decided. ``labelled`` (url, block 0 or 1) is the
    small table to train from, by default a fixed one; or ``model`` comes from ``fit``.

    A null URL, or one without ``://``, has empty host and path, which no rule with a host fits; the model judges them like any other text. Null
    and repeated keys keep their rows; URLs of any length are read whole; other columns are not read; no rows give none. One scan, no shuffle."""
    model = model or fit(labelled_urls(pages.sparkSession) if labelled is None else labelled)
    host, path = host_and_path(F.col(url))
    rows = pages.select(F.col(key).alias("key"), host.alias("host"), path.alias("path"))
    rows = rows.withColumn("ruled", rule_of(F.col("host"), F.col("path"), rules))
    # Rows that a rule decides have no n-grams to count.
    rows = rows.withColumn("grams", F.when(F.col("ruled").isNull(), grams(F.col("host"), F.col("path"))).otherwise(F.array().cast("array<string>")))
    score = F.when(F.col("ruled").isNull(), model.chance(F.col("grams")))
    out = rows.select(F.col("key").alias(key), "host", "path", F.col("ruled.rule").alias("rule"), F.col("ruled.verdict").alias("decided"), score.alias("score"))
    return out.select(key, "host", "path", "rule", F.coalesce("decided", F.when(F.col("score") >= block_from, "block").otherwise("allow")).alias("verdict"), "score")
