"""URL filters: host and path rules, and a logistic regression on hashed character n-grams for the rest.

All of it is DataFrame expressions; the regression is trained by Spark ML from a small labelled URL table.
"""

from __future__ import annotations

from pyspark.ml.classification import LogisticRegression
from pyspark.ml.feature import CountVectorizerModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import table

#: (host, path, verdict)
RULES = (("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"), ("net", "/es/", "block"), ("net", "/fr/", "block"))

#: The labelled table: words of hosts to allow (0) and to block (1), in four languages; a row for each word, domain and path of its turn.
ALLOWED = (
    "news library archive museum weather recipes gardening university school science history poetry music-lessons bakery bicycle hiking astronomy chess-club parish city-hall railway "
    "nachrichten wetter buecherei geschichte kochen garten sportverein schule rathaus zeitung wandern handwerk bibliotheque histoire cuisine jardin mairie ecole musee actualites randonnee "
    "noticias biblioteca historia cocina escuela museo ayuntamiento tiempo poesia deportes senderismo"
).split()
BLOCKED = (
    "casino poker-room slots jackpot betting-tips viagra cialis cheap-pills discount-pharmacy weight-loss-pills xxx-videos porn-tube adult-cams adult-chat escorts sex-dating payday-loans fast-cash win-money "
    "free-prize lottery-winner crypto-profit replica-watches click-ads popunder-ads ad-server pixel-tracker banner-ads spin-and-win buy-followers miracle-cure free-casino-bonus "
    "gratis-sex geld-gewinnen sofort-kredit casino-gratis billige-pillen erotik-kontakte casino-en-ligne argent-facile gagner-argent rencontres-sexe pilules-pas-cher "
    "apuestas-gratis dinero-facil ganar-dinero sexo-gratis casino-bonos pastillas-baratas premios-gratis"
).split()
DOMAINS = ("org", "net", "info", "eu", "de", "fr", "es", "co.uk")
PATHS = ("/", "/index.html", "/a/2041", "/page/7?ref=home", "/2023/05/title-of-it.html", "/en/810", "/item?id=55#top", "/feed/")
LABELLED = [
    (f"https://{prefix}{word}.{DOMAINS[(k + j) % 8]}{PATHS[(3 * k + 5 * j) % 8]}", label)
    for label, words in ((0, ALLOWED), (1, BLOCKED)) for k, word in enumerate(words) for j, prefix in enumerate(("", "www.", "the-", "my-"))
]
#: A shop's path tells what its host doesn't.
LABELLED += [(f"https://shop{k}.{d}/{w}/order", label) for label, words in ((0, ALLOWED[::3]), (1, BLOCKED[::3])) for k, (w, d) in enumerate(zip(words, DOMAINS * 9))]

LENGTHS, FEATURES, THRESHOLD = (3, 4), 1 << 12, 0.5


def host_and_path(url: Column) -> tuple[Column, Column]:
    """After the first :// up to /, ?, # or the end, A-Z lower-cased; then up to ?, # or the end. Both empty for null or without ://."""
    rest = F.when(F.coalesce(F.instr(url, "://"), F.lit(0)) > 0, F.substring_index(F.split_part(F.concat(F.regexp_replace(url, r"(?s)^.*?://", ""), F.lit("#")), F.lit("#"), F.lit(1)), "?", 1)).otherwise("")
    host = F.substring_index(rest, "/", 1)
    path = F.substr(rest, F.length(host) + 1)
    return F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"), path


def matched_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits: its host or a subdomain of it, and a path that starts with the rule's."""
    rule = verdict = F.lit(None).cast("string")
    for h, p, v in sorted(rules, key=lambda r: len(r[0] + r[1])):
        fits = ((host == h) | F.endswith(host, F.lit(f".{h}"))) & F.startswith(path, F.lit(p))
        rule, verdict = F.when(fits, h + p).otherwise(rule), F.when(fits, v).otherwise(verdict)
    return rule, verdict


def n_grams(host: Column, path: Column, lengths=LENGTHS) -> Column:
    """Character n-grams of host and path as strings; those of the host are marked."""

    def of(text: Column, mark: str, n: int) -> Column:
        padded = F.concat(F.lit("^"), text, F.lit("$"))
        # A look-ahead at every place: one walk over the text, however long.
        found = F.regexp_extract_all(padded, F.lit(f"(?s)(?=(.{{{n}}}))"), F.lit(1))
        return F.transform(F.when(F.size(found) > 0, found).otherwise(F.array(padded)), lambda g: F.concat(F.lit(mark), g))

    return F.concat(*[of(t, m, n) for n in lengths for t, m in ((host, "h"), (path, "p"))])


def places(host: Column, path: Column, lengths, features: int) -> Column:
    """The places among the weights, from 1, of the n-grams that a url has."""
    return F.array_distinct(F.transform(n_grams(host, path, lengths), lambda g: F.pmod(F.hash(g), F.lit(features)) + 1))


def train(labelled: DataFrame, lengths=LENGTHS, features: int = FEATURES) -> tuple[list[float], float]:
    """Weights and intercept from (url, label): label 1 is to be blocked."""
    host, path = host_and_path(F.col("url"))
    found = F.transform(places(host, path, lengths, features), lambda i: i.cast("string"))
    rows = labelled.where("label is not null").select(F.col("label").cast("double"), found.alias("places"))
    # Sparse vectors, made in the JVM: place i of the table is term i of a fixed vocabulary.
    terms = CountVectorizerModel.from_vocabulary([str(i + 1) for i in range(features)], inputCol="places", outputCol="features").setBinary(True)
    rows = terms.transform(rows).select("label", "features")
    model = LogisticRegression(maxIter=60, regParam=0.01, standardization=False).fit(rows)
    return [float(w) for w in model.coefficients.toArray()], float(model.intercept)


def probability(host: Column, path: Column, weights: list[float], intercept: float, lengths=LENGTHS) -> Column:
    """The regression as a column expression."""
    table_ = F.array(*[F.lit(w) for w in weights])
    total = F.aggregate(places(host, path, lengths, len(weights)), F.lit(intercept), lambda acc, i: acc + F.element_at(table_, i))
    return 1 / (1 + F.exp(-total))


def judge_urls(pages: DataFrame, labelled: DataFrame, rules=RULES, threshold: float = THRESHOLD) -> DataFrame:
    """Adds host, path, rule, probability (of block, by the regression) and verdict to (page_id, url).

    The longest fitting rule decides; else the regression does, at `threshold`. A null url or one without :// has an empty host and
    path and no rule; the regression judges it as it does any other. Only page_id and url are read. An empty table gives an empty result.
    """
    weights, intercept = train(labelled)
    host, path = host_and_path(F.col("url"))
    rows = pages.select("page_id", "url", host.alias("host"), path.alias("path"))
    rule, verdict = matched_rule(F.col("host"), F.col("path"), rules)
    rows = rows.withColumn("rule", rule).withColumn("by_rule", verdict).withColumn("probability", probability(F.col("host"), F.col("path"), weights, intercept))
    return rows.withColumn("verdict", F.coalesce("by_rule", F.when(F.col("probability") >= threshold, "block").otherwise("allow"))).drop("by_rule")


def labelled_urls(spark: SparkSession) -> DataFrame:
    return spark.sql("SELECT * FROM VALUES " + ", ".join(f"('{u}', {y})" for u, y in LABELLED) + " AS t(url, label)")


def op3_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return judge_urls(table(spark, sf_dir, "pages"), labelled_urls(spark)).select("page_id", "host", "path", "rule", "verdict", "probability")
