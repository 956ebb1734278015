"""URL filter: rules for hosts and paths first, then logistic regression on hashed character n-grams.

The model is fitted on the small labelled table below with Spark's own logistic regression over hashed
3- to 5-grams of host and path; scoring is one map pass in the JVM. Labels stand on sites and on paths, so junk in the
path of an ordinary site is found as well. It knows kinds of junk by their words, in any compound; junk whose words
look like none of the table's is allowed.

Defined cases: a NULL url, or one without ``://``, has an empty host and path, meets no rule and is
allowed; repeated rows and equal or NULL ids are judged one by one; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from kindred.llm.texts import lower_ascii

FEATURES = 1 << 18
GRAMS = (3, 4, 5)
THRESHOLD = 0.5


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


# The rules asked for.
RULES = (
    Rule("allow", "org", "/"), Rule("block", "example.org", "/es/"), Rule("block", "example.org", "/en/1"),
    Rule("allow", "com", "/fr/"), Rule("block", "com", "/de/"),
)

# The labelled table is made of words. A site or a path is to block if it holds a junk word, wherever it stands; words of
# daily life, words that only look like junk, and names without any word in them are ordinary.
JUNK = """casino poker jackpot roulette blackjack slots bingo betting bets bookmaker gamble lotto scratchcards
viagra cialis pills pharma-deals xanax tramadol steroids slimming potency
porn xxx sex sexy adult escorts webcams nude hentai erotic hookup milf cams
payday loanshark getrich cryptodoubler bitcoin-doubler forexsignals
warez cracked keygen serials torrents pirated malware spyware adware phishing
spam linkfarm clickbait ads adserver popunder tracker replica fakewatches ringtones giveaway prizes
spielbank wetten sportwetten potenzmittel paris-sportifs rencontres-coquines apuestas tragaperras pastillas-baratas""".split()
ORDINARY = """hall library school garden museum hiking weather science recipes town journal archive university
travel bakery railway harbour village choir chess physics maths birdwatch observatory brigade county orchestra theatre
bookshop carpenter newspaper parliament hospital dentist veterinary plumber kindergarten grammar students alumni
verwaltung stadtwerke gemeinde bibliothek wanderverein feuerwehr handwerk zeitung rathaus gesundheit mairie recettes
jardinage actualites randonnee boulangerie patrimoine lycee musique ayuntamiento biblioteca cocina noticias escuela
deportes turismo historia universidad periodico translation thesaurus geography literature philosophy engineering
electronics architecture photography astronomy meteorology chemistry biology geology economics statistics languages
dictionary bridge river mountain forest island castle market kitchen furniture tailor cinema radio football swimming
essex sussex adsorption advent address adventure betony alphabet diabetes beta pilsner spillway caterpillar pilgrim
crackers classic analysis bingham loaning railtrack trackside farmhouse farming windmill winter window freedom freezer
cheapside xylophone sportsclub camera camping campus cameo serial serially nudibranch escorial slotted hackney
prizren pornic poketown torrential warehouse lottie clothing bathing building
painting spring meeting wedding evening thinking author eastern southern anthem the-other""".split()
PARTS = "royal best grand top my online live world zone hub star direct now central daily shop point box line house".split()
SYLLABLES = "ba del fo gur hi jem ka lor mi nus pe qua ris so tun ve wo xi yar zet".split()
ENDINGS = [".com", ".net", ".org", ".info", ".eu", ".de", ".fr", ".es", ".co.uk", ".io"]
PREFIXES = ["", "www.", "shop.", "forum."]
PLAIN_PATHS = ["", "/", "/index.html", "/2019/07/a", "/12", "/archive/334.html", "/about", "/p/8891/", "/news/today", "/a/b/c"]


def host(url: Column) -> Column:
    return F.coalesce(lower_ascii(F.regexp_extract(_rest(url), r"^([^/?#]*)", 1)), F.lit(""))


def path(url: Column) -> Column:
    return F.coalesce(F.regexp_extract(_rest(url), r"^[^/?#]*([^?#]*)", 1), F.lit(""))


def _rest(url: Column) -> Column:
    """What follows the first ``://``; empty without one."""
    text = F.coalesce(url, F.lit(""))
    at = F.locate("://", text)
    return F.when(at > 0, F.substring(text, at + 3, F.length(text))).otherwise(F.lit(""))


def _fits(rule: Rule) -> Column:
    on_host = (F.col("host") == rule.host) | F.col("host").endswith("." + rule.host)
    return on_host & F.col("path").startswith(rule.path)


def _longest(rules: tuple[Rule, ...], value) -> Column:
    """The value of the longest rule that fits; rules are tried from long to short."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.name), r.name)):
        out = F.when(_fits(rule), F.lit(value(rule))).otherwise(out)
    return out


def grams(host_column: Column, path_column: Column) -> Column:
    """Character n-grams of host and path, each closed by blanks: a word is the same in either."""

    def cut(text: Column) -> Column:
        closed = F.concat(F.lit(" "), text, F.lit(" "))
        return F.concat(*[_windows(closed, n) for n in GRAMS])

    return F.concat(cut(host_column), cut(lower_ascii(path_column)))


def _windows(text: Column, n: int) -> Column:
    """Every run of ``n`` characters, found in one pass over the text."""
    return F.regexp_extract_all(text, F.lit(rf"(?s)(?=(.{{{n}}}))"), F.lit(1))


def _hashed(rows: DataFrame) -> DataFrame:
    with_grams = rows.withColumn("_grams", grams(F.col("host"), F.col("path")))
    return HashingTF(inputCol="_grams", outputCol="_features", numFeatures=FEATURES, binary=True).transform(with_grams)


def _sites() -> list[tuple[str, float]]:
    """Names of sites with their label: a word alone, and with other parts before and behind it."""
    out = []
    for label, names, times in ((1.0, JUNK, 8), (0.0, ORDINARY, 6)):
        for i, name in enumerate(names):
            out.append((name, label))
            for k in range(times):
                part = PARTS[(i + 5 * k) % len(PARTS)]
                out.append(((f"{part}-{name}", f"{name}{part}", f"{part}{name}", f"{name}-{part}")[k % 4], label))
    n = len(SYLLABLES)
    for i in range(2 * n * n):
        out.append((SYLLABLES[i % n] + SYLLABLES[i // n % n] + (SYLLABLES[(7 * i + i // n) % n] if i % 3 else ""), 0.0))
    return out


def _paths() -> list[tuple[str, float]]:
    """Paths with their label; shapes are the same for both."""
    out = []
    for label, names in ((1.0, JUNK), (0.0, ORDINARY)):
        for i, name in enumerate(names):
            a, b = PARTS[(3 * i + 1) % len(PARTS)], PARTS[(7 * i + 2) % len(PARTS)]
            out += [(path, label) for path in (f"/{name}/", f"/{a}/{name}-{i}.html", f"/{a}-{name}", f"/{b}-{name}-{a}/{i}", f"/en/{name}/{b}")]
    return out


def labelled(spark: SparkSession) -> DataFrame:
    """``host, path, label``: sites under plain paths, and paths on ordinary sites."""
    sites, rows = _sites(), []
    ordinary = [site for site, label in sites if label == 0.0]
    for i, (site, label) in enumerate(sites):
        rows.append((PREFIXES[i % len(PREFIXES)] + site + ENDINGS[i % len(ENDINGS)], PLAIN_PATHS[(3 * i) % len(PLAIN_PATHS)], label))
    for i, (path, label) in enumerate(_paths()):
        rows.append((PREFIXES[(i // 3) % len(PREFIXES)] + ordinary[(11 * i) % len(ordinary)] + ENDINGS[(7 * i) % len(ENDINGS)], path, label))
    return spark.createDataFrame(rows, "host string, path string, label double").coalesce(1)


def fit(table: DataFrame) -> LogisticRegressionModel:
    """A model from rows of ``host, path, label``; the table is small and stays in one partition."""
    learner = LogisticRegression(
        featuresCol="_features", labelCol="label", regParam=0.0005, maxIter=60, probabilityCol="_chances",
        rawPredictionCol="_raw", predictionCol="_prediction",
    )
    return learner.fit(_hashed(table).cache())


def judge(
    pages: DataFrame, model: LogisticRegressionModel, key: str = "page_id", url: str = "url",
    rules: tuple[Rule, ...] = RULES,
) -> DataFrame:
    """``key, host, path, rule, verdict, score``; the score is the model's chance that the URL is to block."""
    parted = pages.select(F.col(key).alias("_key"), host(F.col(url)).alias("host"), path(F.col(url)).alias("path"))
    scored = model.transform(_hashed(parted))
    chance = F.when(F.col("host") == "", F.lit(0.0)).otherwise(vector_to_array(F.col("_chances"))[1])
    own = F.when(F.col("score") >= THRESHOLD, F.lit("block")).otherwise(F.lit("allow"))
    return scored.withColumn("score", chance).select(
        F.col("_key").alias(key), "host", "path", _longest(rules, lambda r: r.name).alias("rule"),
        F.coalesce(_longest(rules, lambda r: r.verdict), own).alias("verdict"), F.round("score", 6).alias("score"),
    )
