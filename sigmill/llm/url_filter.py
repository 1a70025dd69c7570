"""URL filters, in DataFrame and Spark ML functions only: allow and block rules, then a trained judgement.

Rules name a host and the beginning of a path. A rule fits its host and all of the host's subdomains; the longest
fitting rule decides (of equally long ones the first in byte order). Where none fits, logistic regression on hashed
character n-grams of host and path decides, trained from a small labelled table of URLs.

Host: after the first "://" up to "/", "?", "#" or the end, A-Z lower-cased; path: from there up to "?", "#" or the
end. A null URL, or one without "://", has an empty host and path; no rule fits it and the model judges it like any
other. Repeated rows are each judged; other columns pass through, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.ml.classification import LogisticRegression, LogisticRegressionModel
from pyspark.ml.feature import HashingTF
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ._shared import ascii_lower, fresh

FEATURES = 1 << 14
GRAMS = (3, 4)


@dataclass(frozen=True)
class Rule:
    verdict: str
    text: str  # host and path beginning, such as "example.com/en/"

    @property
    def host(self) -> str:
        return self.text.partition("/")[0]

    @property
    def path(self) -> str:
        slash = self.text.find("/")
        return self.text[slash:] if slash >= 0 else ""


#: The rules of the query.
RULES = (Rule("block", "com/en/"), Rule("allow", "example.com/en/7"), Rule("allow", "net/de/"), Rule("block", "example.net/de/8"), Rule("block", "org/es/"))

#: Names of the categories of a public list of hosts by content (Université Toulouse Capitole), in its order:
#: those that a crawl for text leaves out, and the others.
BLOCKED_KINDS = """adult agressif cryptojacking dangerous-material dating ddos dialer drogue fakenews gambling hacking lingerie
malware marketingware mixed-adult phishing publicite redirector sect stalkerware tricheur warez""".split()
ALLOWED_KINDS = """associations-religieuses astrology audio-video bank bitcoin blog celebrity chat child cleaning cooking download
educational-games financial forums games jobsearch manga mobile-phone press radio reaffected sexual-education shopping shortener
social-networks sports translation update vpn webhosting webmail""".split()
#: Hosts of the table for each kind, and made-up hosts without one for each kind.
HOSTS, PLAIN = 10, 12
SUBDOMAINS = ("", "www.", "web.", "m.", "en.")
DOMAINS = (".com", ".org", ".net", ".info", ".co.uk", ".example.com", ".example.org", ".example.net")
PATHS = ("/", "/index.html", "/en/", "/fr/", "/articles/", "/a/b/", "/?id=")


def _made_up(k: int) -> str:
    """A name that can be spoken but is no word: open and closed syllables counted off by k."""
    out = ""
    for _ in range(2 + k % 3):
        k, c = divmod(k * 7 + 3, 13)
        k, v = divmod(k + 11 * c, 5)
        out += "bdfghklmnrstw"[c] + "aeiou"[v] + ("", "n", "r", "th", "s")[(k + c) % 5]
        k += 17 * c + v + 1
    return out


def labelled_urls(blocked: list[str] = BLOCKED_KINDS, allowed: list[str] = ALLOWED_KINDS) -> list[tuple[str, int]]:
    """(url, 1 to block): each kind beside made-up names, before and behind them and alone, and made-up names without a kind."""
    hosts, k = [], 0
    for label, kinds in ((1, blocked), (0, allowed)):
        for kind in kinds:
            for form in range(HOSTS):
                k += 1
                name = _made_up(k)
                hosts.append(((kind, f"{kind}-{name}", f"{name}-{kind}", f"{kind}{name}", f"{name}{kind}")[form % 5], label))
    hosts += [(_made_up(k + j) + ("-" + _made_up(k + 7 * j) if j % 3 == 0 else ""), 0) for j in range(PLAIN * (len(blocked) + len(allowed)))]
    return [(f"https://{SUBDOMAINS[k % 5]}{host}{DOMAINS[(k // 5) % 8]}{PATHS[(k // 3) % 7]}{37 * k % 9973}", label) for k, (host, label) in enumerate(hosts)]


def split_url(url: Column) -> dict[str, Column]:
    after = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url))).otherwise("")
    after = F.coalesce(after, F.lit(""))
    host = F.regexp_extract(after, r"^[^/?#]*", 0)
    return {"host": ascii_lower(host), "path": F.regexp_extract(after, r"(?s)^[^/?#]*([^?#]*)", 1)}


def with_host_and_path(df: DataFrame, url: str = "url") -> DataFrame:
    """df with host and path; columns of these names are replaced."""
    return df.withColumns(split_url(F.col(url).cast("string")))


def _grams(text: Column) -> Column:
    """Character n-grams of a text, marked at both ends."""
    marked = F.concat(F.lit("^"), text, F.lit("$"))

    def of(n: int) -> Column:
        return F.transform(F.sequence(F.lit(1), F.greatest(F.length(marked) - n + 1, F.lit(1))), lambda i: F.substring(marked, i, F.lit(n)))

    return F.concat(*map(of, GRAMS))


def with_features(df: DataFrame, out: str) -> DataFrame:
    """df with the hashed n-grams of host and path in the column `out`."""
    tag = lambda name, grams: F.transform(grams, lambda g: F.concat(F.lit(name), g))
    (grams,) = fresh(df, "grams")
    df = df.withColumn(grams, F.concat(tag("h ", _grams(F.col("host"))), tag("p ", _grams(F.col("path")))))
    return HashingTF(numFeatures=FEATURES, binary=True, inputCol=grams, outputCol=out).transform(df).drop(grams)


def train(spark: SparkSession, rows: list[tuple[str, int]] | None = None) -> LogisticRegressionModel:
    """Rows (url, 1 for block): a small table; the fit runs on the executors."""
    labelled = spark.createDataFrame(rows or labelled_urls(), "url string, label int").coalesce(1)
    features = with_features(with_host_and_path(labelled), "features").cache()
    try:
        return LogisticRegression(maxIter=25, regParam=0.003).fit(features)
    finally:
        features.unpersist()


def rule_for(host: Column, path: Column, rules: tuple[Rule, ...] = RULES) -> Column:
    """The text of the longest fitting rule, or null. The rules are a short list and become one CASE."""
    out = F.lit(None).cast("string")
    for rule in sorted(rules, key=lambda r: (len(r.text), [-b for b in r.text.encode()])):
        fits = ((host == rule.host) | F.endswith(host, F.lit("." + rule.host))) & F.startswith(path, F.lit(rule.path))
        out = F.when(fits, F.lit(rule.text)).otherwise(out)
    return out


def judge_urls(df: DataFrame, url: str = "url", rules: tuple[Rule, ...] = RULES, model: LogisticRegressionModel | None = None) -> DataFrame:
    """df with host, path, rule and verdict (allow or block); columns of these names are replaced, all others pass through."""
    model = (model or train(df.sparkSession)).copy()
    features, prediction = fresh(df, "features", "prediction")
    model = model.setFeaturesCol(features).setPredictionCol(prediction).setRawPredictionCol("").setProbabilityCol("")
    out = with_host_and_path(df, url).withColumn("rule", rule_for(F.col("host"), F.col("path"), rules))
    by_rule = F.lit(None).cast("string")
    for rule in rules:
        by_rule = F.when(F.col("rule") == rule.text, rule.verdict).otherwise(by_rule)
    verdict = F.coalesce(by_rule, F.when(F.col(prediction) > 0.5, "block").otherwise("allow"))
    return model.transform(with_features(out, features)).withColumn("verdict", verdict).drop(features, prediction)
