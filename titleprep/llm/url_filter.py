"""URL filter: rules first, then a ratio of two character language models.

Rules decide the addresses that they fit.  Those addresses are also the examples
from which two variable-order Markov models are counted, one of accepted and one of
rejected addresses (host and path).  A character's probability interpolates the
counts after 0 to ``order`` preceding characters (Witten-Bell: a context hands on
weight for the number of different characters seen after it), so an unseen context
falls back on the longest one that was seen.  An address without a rule is accepted
when its log-likelihood difference per character reaches a threshold, which is
calibrated on a fifth of the examples that the counts leave out.

Counts are taken over all distinct examples; everything is a native expression.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from titleprep.scale import lookup, reread, store

RULES = (
    ("com/", "allow"),
    ("example.com/en/", "block"),
    ("www.example.com/en/", "allow"),
    ("net/es/", "block"),
    ("net/fr/", "block"),
)
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
_BEGIN, _END = "\x02", "\x03"
_ALPHABET = 256.0
_FOLDS = 5
_MICRO = 1_000_000  # log ratios are whole numbers of this part, so that sums are exact
_BIN = 10_000  # width of a bin of scores, 0.01
_BINS = 500  # bins on either side of zero


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path; both empty for null and for a text without ``://``."""
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substr(url, at + 3)).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    host = F.regexp_extract(rest, "^[^/?#]*", 0)
    path = F.regexp_extract(rest, "^[^/?#]*([^?#]*)", 1)
    return F.translate(host, _UPPER, _LOWER), path


def matching_rule(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits, and its verdict; null without one."""

    def fits(rule: str) -> Column:
        domain, _, start = rule.partition("/")
        inside = (host == domain) | F.endswith(host, F.lit("." + domain))
        return inside & F.startswith(path, F.lit("/" + start))

    longest = sorted(rules, key=lambda r: (-len(r[0]), r[0]))
    rule = F.coalesce(*[F.when(fits(r), F.lit(r)) for r, _ in longest], F.lit(None).cast("string"))
    verdict = F.coalesce(*[F.when(fits(r), F.lit(v)) for r, v in longest], F.lit(None).cast("string"))
    return rule, verdict


def _fold(text: Column) -> Column:
    """A number below _FOLDS that depends on the text alone."""
    return F.conv(F.left(F.md5(text), F.lit(7)), 16, 10).cast("long") % _FOLDS


@dataclass(frozen=True)
class UrlFilter:
    """Adds ``host``, ``path``, ``rule`` and ``verdict`` to pages; other columns stay.

    Columns with these names are replaced.  A null address is an empty one.  Equal
    addresses get equal verdicts, however often they come; each counts once as an
    example.  Without examples of both kinds the threshold is zero and, without
    any, everything without a rule is allowed.  An empty table gives an empty table.
    """

    order: int = 4
    rules: tuple = RULES
    url_col: str = "url"

    def _grams(self, texts: DataFrame) -> DataFrame:
        """``texts (_text, ...)`` exploded to one ``_gram`` (context and character) per character."""
        padded = F.concat(F.lit(_BEGIN * self.order), F.col("_text"), F.lit(_END))
        places = F.sequence(F.lit(1), F.length("_text") + 1)
        grams = F.transform(places, lambda i: F.substring(padded, i, F.lit(self.order + 1)))
        return texts.withColumn("_gram", F.explode(grams))

    def _ratios(self, counted: DataFrame, asked: DataFrame) -> DataFrame:
        """``(_gram, _ratio)`` for the distinct ``asked (_gram)``, from ``counted (_gram, _yes, _no)``."""
        orders = F.sequence(F.lit(0), F.lit(self.order))

        def endings(df: DataFrame) -> DataFrame:
            return df.withColumn("_k", F.explode(orders)).withColumn(
                "_seen", F.right("_gram", F.col("_k") + 1)
            )

        sums = [F.sum(c).alias(c) for c in ("_yes", "_no")]
        seen = store(endings(counted).groupBy("_k", "_seen").agg(*sums))
        contexts = store(
            seen.df.groupBy("_k", F.left("_seen", F.col("_k")).alias("_context")).agg(
                F.sum("_yes").alias("_yes_n"),
                F.sum("_no").alias("_no_n"),
                F.count_if(F.col("_yes") > 0).alias("_yes_types"),
                F.count_if(F.col("_no") > 0).alias("_no_types"),
            )
        )
        wanted = endings(asked).withColumn("_context", F.left("_seen", F.col("_k")))
        fields = ("_yes", "_no", "_yes_n", "_no_n", "_yes_types", "_no_types")
        # short contexts are those of very many strings
        found = (
            lookup(lookup(wanted, [seen], ["_k", "_seen"]), [contexts], ["_k", "_context"])
            .groupBy("_gram")
            .agg(
                F.array_sort(
                    F.collect_list(F.struct("_k", *[F.coalesce(f, F.lit(0)).alias(f) for f in fields]))
                ).alias("_levels")
            )
        )

        def deeper(chance: Column, level: Column) -> Column:
            def one(kind: str) -> Column:
                lower = chance[kind]
                weight = level[f"{kind}_types"]
                total = level[f"{kind}_n"]
                value = (level[kind] + weight * lower) / F.nullif(total + weight, F.lit(0))
                return F.coalesce(value, lower).alias(kind)

            return F.struct(one("_yes"), one("_no"))

        start = F.struct(F.lit(1 / _ALPHABET).alias("_yes"), F.lit(1 / _ALPHABET).alias("_no"))
        ratio = F.aggregate("_levels", start, deeper, lambda c: F.log(c["_yes"]) - F.log(c["_no"]))
        return found.select("_gram", F.round(ratio * _MICRO).cast("long").alias("_ratio"))

    def _threshold(self, scored: DataFrame) -> DataFrame:
        """One row: the least score, in bins, that best splits held-out examples; zero without both kinds."""
        held_out = scored.where("_held and _label is not null")
        place = F.greatest(F.lit(-_BINS), F.least(F.lit(_BINS), F.floor(F.col("_score") / _BIN)))
        bins = held_out.groupBy(place.cast("int").alias("_bin")).agg(
            F.count_if(F.col("_label") == "allow").alias("_yes"),
            F.count_if(F.col("_label") == "block").alias("_no"),
        )
        # at most 2 * _BINS + 1 bins: one row holds them all
        whole = bins.groupBy(F.lit(0).alias("_all")).agg(
            F.array_sort(F.collect_list(F.struct("_bin", "_yes", "_no"))).alias("_bins"),
            F.sum("_yes").alias("_yes"),
            F.sum("_no").alias("_no"),
        )

        def share(bin_: Column) -> Column:
            above = F.filter("_bins", lambda b: b["_bin"] >= bin_)
            below = F.filter("_bins", lambda b: b["_bin"] < bin_)
            yes = F.aggregate(above, F.lit(0).cast("long"), lambda s, b: s + b["_yes"])
            no = F.aggregate(below, F.lit(0).cast("long"), lambda s, b: s + b["_no"])
            # share of accepted kept and of rejected dropped, as whole numbers
            return yes * F.col("_no") + no * F.col("_yes")

        scores = F.transform(
            "_bins", lambda b: F.struct(share(b["_bin"]).alias("good"), (-b["_bin"]).alias("minus"))
        )
        best = F.when((F.col("_yes") > 0) & (F.col("_no") > 0), -F.array_max(scores)["minus"])
        return whole.select((F.coalesce(best, F.lit(0)) * _BIN).alias("_least"))

    def __call__(self, pages: DataFrame) -> DataFrame:
        url = F.col(f"`{self.url_col}`")
        host, path = host_and_path(url)
        results = ("host", "path", "rule", "verdict")
        columns = [f"`{c}`" for c in pages.columns if c.lower() not in results]
        # no name of the caller's columns can meet one used here
        parsed = pages.select(F.struct(*columns).alias("_page"), host.alias("host"), path.alias("path"))
        rule, verdict = matching_rule(F.col("host"), F.col("path"), self.rules)
        judged = parsed.withColumns({"rule": rule, "verdict": verdict})

        text = F.concat("host", "path").alias("_text")
        label = F.col("verdict").alias("_label")
        texts = reread(
            judged.select(text, label)
            .distinct()
            .withColumn("_held", _fold(F.col("_text")) == 0)
        )
        counted = reread(
            self._grams(texts.where("_label is not null and not _held"))
            .groupBy("_gram")
            .agg(
                F.count_if(F.col("_label") == "allow").alias("_yes"),
                F.count_if(F.col("_label") == "block").alias("_no"),
            )
        )
        asked = texts.where("_label is null or _held")
        ratios = store(self._ratios(counted, self._grams(asked).select("_gram").distinct()))
        sums = (
            lookup(self._grams(asked), [ratios], ["_gram"], copies=True)
            .groupBy("_text", "_label", "_held")
            .agg((F.sum("_ratio") / F.count(F.lit(1))).alias("_score"))
        )
        scored = reread(sums)
        least = self._threshold(scored).first()
        least = least["_least"] if least else 0
        decided = scored.where("_label is null").select(
            F.col("_text"), F.when(F.col("_score") >= least, "allow").otherwise("block").alias("_model")
        )
        joined = judged.withColumn("_text", F.when(F.col("verdict").isNull(), F.concat("host", "path")))
        done = joined.join(decided, "_text", "left")
        return done.select(
            "_page.*",
            "host",
            "path",
            "rule",
            F.coalesce("verdict", "_model", F.lit("allow")).alias("verdict"),
        )
