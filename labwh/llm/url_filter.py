"""URL filter: domain rules first, then logistic regression on hashed character trigrams.

Scoring is DataFrame code only. The model is fitted on the driver from a small labelled table whose
size is bounded by ``max_examples``; only its weights (one literal array) travel with the plan.
Host and path have buckets of their own. Trigrams know words by their parts: of words that share
none with the table they say little, and such URLs are mostly allowed.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from labwh.llm.common import doubles, pick

UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
DIGITS = "0123456789"

#: General vocabulary of the labelled table, in the languages of the pages. No word of a given page's host is in it.
UNWANTED_WORDS = tuple(
    "poker roulette jackpot slots lottery blackjack betting gambling wager bookmaker bingo baccarat winner winnings "
    "payout highroller kasino cassino gewinnspiel wetten apuestas tragaperras loterie croupier sweepstake scratchcard "
    "viagra cialis pharmacy meds tablets pill steroids slimming dietpill weightloss painkiller xanax tramadol "
    "pastillas pilules potenzmittel abnehmen botox "
    "porn xxx sexy nude escort erotic webcam hookup fetish milf lingerie camgirls erotik desnudas swinger "
    "loan payday credit cash lending refinance quickcash forex binary bitcoin doubler earnings millionaire kredit "
    "prestamo dinero richquick moneymaker ponzi "
    "advert adserver banner popup clickbait affiliate tracker pixel retarget doubleclick traffic impressions "
    "backlinks linkfarm seoboost phishing malware keygen warez cracked torrent serials counterfeit replica "
    "knockoff giveaway freebie gratis discount bargain cheapest coupon prizes unlock spyware scam".split())
WANTED_WORDS = tuple(
    "library museum garden weather school university science history travel recipes nature council hospital theatre "
    "orchestra cinema gallery archive forum journal research physics chemistry biology geology astronomy "
    "mathematics engineering software compiler database network hardware robotics energy climate forest mountain "
    "river ocean island village harbour railway station airport bridge castle church cathedral festival concert "
    "football tennis cycling sailing hiking swimming athletics chess kitchen bakery restaurant coffee cooking "
    "farming vineyard market craft pottery painting sculpture photography architecture furniture "
    "bibliothek schule zeitung wetter rathaus verein wandern musik geschichte wissenschaft nachrichten "
    "bibliotheque musee ecole cuisine jardin voyage histoire mairie recherche "
    "biblioteca escuela ciencia noticias cocina historia ayuntamiento viajes "
    "parliament government election justice police fire rescue health medicine dentist children family "
    "teacher student lesson dictionary grammar translation novel poetry author publisher newspaper magazine radio "
    "broadcast podcast language culture society economy industry company support manual download contact".split())
#: The same on both sides, so that the model learns nothing from them.
PREFIXES = ("", "www.", "blog.", "m.")
SUFFIXES = (".test", ".com", ".org", ".net", ".de", ".fr", ".es", ".example.test")
TAILS = ("", "/", "/1", ".html", "/index.html", "/23/")
FOLDERS = ("", "/en", "/de", "/fr", "/es")


def labelled(unwanted: Sequence[str] = UNWANTED_WORDS, wanted: Sequence[str] = WANTED_WORDS,
             rounds: int = 2) -> tuple[tuple[str, int], ...]:
    """URLs made from the words, ten for each word of the longer list and round; 1 is unwanted. Host and path are
    drawn independently of each other; a URL is unwanted if one of them is. Wanted are also made-up names (names of
    firms say nothing) and paths without words."""

    def brand(i: int) -> str:
        i = i * 2654435761 % 2**32
        return "".join(("bcdfghjklmnprstvwyz", "aeiou")[k % 2][(i >> 4 * k + 3) % (19, 5)[k % 2]] for k in range(5 + i % 3))

    def name(words: Sequence[str], i: int, step: int) -> str:
        one, two = words[i % len(words)], words[(i * 7 + step) % len(words)]
        return (one, f"{one}-{two}", f"{two}{one}", f"{two}-{one}")[(i + step) % 4]

    def host(label: str, i: int) -> str:
        return PREFIXES[i % len(PREFIXES)] + label + SUFFIXES[i // 2 % len(SUFFIXES)]

    def path(label: str, i: int) -> str:
        return FOLDERS[i % len(FOLDERS)] + "/" + label + TAILS[i // 2 % len(TAILS)]

    def plain(i: int) -> str:
        return ("", "/", "/1", "/4.html", "/23/", "/index.html")[i % 6] if i % 3 else path(str(i % 97), i)

    rows = []
    for k in range(rounds):
        for n in range(max(len(unwanted), len(wanted))):
            i, a, b = n + k, 3 + 8 * k, 5 + 8 * k
            good, bad, firm = name(wanted, n, a), name(unwanted, n, a), brand(2 * i + k)
            ten = [
                (host(good, i) + path(name(wanted, n, b), i), 0),
                (host(unwanted[n % len(unwanted)], i) + plain(i), 1),
                (host(good, i + 1) + plain(i), 0),
                (host(bad, i) + path(name(wanted, n, b), i), 1),
                (host(firm, i) + plain(i + 1), 0),
                (host(bad, i + 1) + plain(i + 1), 1),
                (host(firm, i + 1) + path(name(wanted, n, a), i + 1), 0),
                (host(firm, i) + path(name(unwanted, n, b), i), 1),
                (host(name(wanted, n, b), i) + path(brand(2 * i + k + 9999), i), 0),
                (host(good, i) + path(bad, i + 1), 1),
            ]
            rows += ten[5:] + ten[:5] if n % 2 else ten  # so that either half of a split has every kind
    return tuple((f"https://{url}", label) for url, label in rows)


LABELLED = labelled()


@dataclass(frozen=True)
class Rule:
    """``verdict`` for ``host`` and its subdomains where the path starts with ``path``."""

    verdict: str
    host: str
    path: str

    @property
    def name(self) -> str:
        return self.host + self.path


@dataclass(frozen=True)
class UrlModel:
    """Weight of each hash bucket and the intercept of the logistic regression."""

    weights: tuple[float, ...]
    bias: float


def split_url(url: str | None) -> tuple[str, str]:
    """Host and path as the columns below define them; for the labelled table only."""
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = rest
    for mark in "/?#":
        host = host.split(mark, 1)[0]
    path = rest[len(host):].split("?", 1)[0].split("#", 1)[0]
    return host.translate(str.maketrans(UPPER, UPPER.lower())), path


def _buckets(text: str, salt: int, size: int) -> set[int]:
    codes = [ord(c) for c in f"^{text}$"]
    return {(a * 961 + b * 31 + c + salt) % size for a, b, c in zip(codes, codes[1:], codes[2:])}


#: Trigrams of printable ASCII (33 to 126) span SPAN numbers. With twice as many buckets each has a bucket of its
#: own, hosts' and paths' apart. Other characters can meet any bucket, and letters 31 apart share one.
SPAN = (126 - 33) * (961 + 31 + 1) + 1
SALTS = {"host": 0, "path": SPAN}


@lru_cache(maxsize=8)
def fit(examples: Sequence[tuple[str, int]] = LABELLED, size: int = 2 * SPAN, ridge: float = 0.02,
        steps: int = 400, max_examples: int = 10_000) -> UrlModel:
    """Ridge logistic regression by gradient descent with momentum, classes weighted alike. No examples give a model
    that blocks nothing. Weights are rounded, so they do not depend on the machine's last bits. ``ridge`` is shared
    out among the buckets that occur."""
    examples = tuple(examples)
    if len(examples) > max_examples:
        raise ValueError(f"the labelled table is meant to be small: at most {max_examples} rows")
    if not examples:
        return UrlModel((0.0,) * size, -1.0)
    found = []
    for url, _ in examples:
        host, path = split_url(url)
        flat = path.translate(str.maketrans(DIGITS, "0" * 10))
        found.append(sorted(_buckets(host, SALTS["host"], size) | _buckets(flat, SALTS["path"], size)))
    used = np.unique(np.concatenate(found).astype(int))  # the other weights stay 0
    x = np.zeros((len(examples), len(used)))
    for i, buckets in enumerate(found):
        x[i, np.searchsorted(used, buckets)] = 1
    y = np.array([label for _, label in examples], dtype=float)
    share = np.where(y == 1, 0.5 / max(1, (y == 1).sum()), 0.5 / max(1, (y == 0).sum()))
    w, b, v, u = np.zeros(len(used)), 0.0, np.zeros(len(used)), 0.0
    rate = 4.0 / (x.sum(1).max() + 1)
    for _ in range(steps):
        error = share * (1 / (1 + np.exp(-(x @ w + b))) - y)
        v = 0.9 * v - rate * (x.T @ error + ridge * w / len(used))
        u = 0.9 * u - rate * error.sum()
        w, b = w + v, b + u
    weights = np.zeros(size)
    weights[used] = np.round(w, 6)
    return UrlModel(tuple(weights.tolist()), round(float(b), 6))


def host_of(url: Column) -> Column:
    """Host after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased."""
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    return F.translate(F.regexp_extract(rest, r"^[^/?#]*", 0), UPPER, UPPER.lower())


def path_of(url: Column) -> Column:
    at = F.locate("://", url)
    rest = F.when(at > 0, url.substr(at + 3, F.length(url))).otherwise("")
    return F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def _bucket_column(text: Column, salt: int, size: int) -> Column:
    codes = F.transform(F.split(F.concat(F.lit("^"), text, F.lit("$")), ""), lambda c: F.ascii(c).cast("long"))
    rolled = F.zip_with(
        F.zip_with(codes, F.slice(codes, 2, F.length(text) + 2), lambda a, b: a * 961 + b * 31),
        F.slice(codes, 3, F.length(text) + 2),
        lambda a, c: F.pmod(a + c + salt, F.lit(size)).cast("int"),
    )
    return F.array_distinct(F.filter(rolled, lambda x: x.isNotNull()))


def classify(pages: DataFrame, rules: Sequence[Rule], model: UrlModel | None = None) -> DataFrame:
    """page_id, host, path, rule, score and verdict of every url.

    The longest fitting rule decides (ties: the first given); without one the model does, with
    ``block`` from probability 0.5 on. NULL urls and urls without ``://`` have empty host and path
    and are scored like any other. Rows are neither dropped nor merged; extra columns are dropped.
    """
    model = model or fit()
    size = len(model.weights)
    t = pick(pages, "page_id", "url").select("page_id", F.coalesce("url", F.lit("")).alias("url"))
    t = t.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    host, path = F.col("host"), F.col("path")
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for r in sorted(reversed(rules), key=lambda r: len(r.name)):  # the longest is asked first
        fits = ((host == r.host) | host.endswith("." + r.host)) & path.startswith(r.path)
        rule = F.when(fits, r.name).otherwise(rule)
        verdict = F.when(fits, r.verdict).otherwise(verdict)
    flat = F.translate(path, DIGITS, "0" * 10)
    t = t.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"),
                 _bucket_column(host, SALTS["host"], size).alias("h"), _bucket_column(flat, SALTS["path"], size).alias("p"))
    weights = doubles(model.weights)
    logit = F.aggregate(F.array_sort(F.array_union("h", "p")), F.lit(model.bias),
                        lambda s, b: s + F.get(weights, b))
    t = t.select("page_id", "host", "path", "rule", "ruled", (1 / (1 + F.exp(-logit))).alias("score"))
    return t.select("page_id", "host", "path", "rule", "score",
                    F.coalesce("ruled", F.when(F.col("score") >= 0.5, "block").otherwise("allow")).alias("verdict"))
