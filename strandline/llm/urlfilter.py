"""URL filters: host and path rules first, a hashed character n-gram logistic regression for the rest."""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strandline.llm.common import batch, prefix_hash, slices, span_hash

#: (host suffix, path prefix, verdict)
RULES = (("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow"))
#: Rows of the labelled table.
LABELLED = 3000
#: How names of hosts are made, and how often, in tenths, in each class: (what, to block, others).  These are lexical signs that the literature on
#: malicious and spam urls has long used: hyphens, digits among letters, strings that cannot be spoken, addresses instead of names, depth.
HABITS = (
    ("one word", 1, 56),
    ("two words run together", 2, 26),
    ("two words with a hyphen", 34, 8),
    ("three words or more with hyphens", 24, 2),
    ("digits after a word", 10, 5),
    ("digits among letters", 14, 1),
    ("letters that cannot be spoken", 8, 1),
    ("a numeric address", 3, 0),
    ("names before the name", 4, 1),
)

# fixed values: beginnings, middles and ends of syllables that can be spoken
ONSETS = [*"bcdfghjklmnprstvwyz", "bl", "br", "ch", "cl", "cr", "dr", "fl", "fr", "gl", "gr", "ph", "pl", "pr", "qu", "sh", "sl", "sp", "st", "th", "tr", "wh", ""]
VOWELS = [*"aeiouaeiou", "ai", "ea", "ee", "ie", "io", "oo", "ou", "y"]
CODAS = ["", "", "", "", *"dglmnprstx", "ck", "ct", "ld", "ll", "nd", "ng", "nt", "rd", "rt", "sh", "ss", "st", "th"]


def labelled_urls(n: int = LABELLED, seed: int = 2) -> tuple[tuple[str, int], ...]:
    """The small labelled table the classifier is trained from: (url, 1 for urls to block), as many of each class.

    Names are random syllables, so no word tells the classes apart, only the habits by which names are made; www., endings and
    most paths go round in both classes alike.
    """
    rng = random.Random(seed)

    def word() -> str:
        return "".join(rng.choice(ONSETS) + rng.choice(VOWELS) + rng.choice(CODAS) for _ in range(rng.choice([1, 2, 2, 3])))

    def name(habit: str) -> str:
        if habit == "one word":
            return word()
        if habit == "two words run together":
            return word() + word()
        if habit == "two words with a hyphen":
            return f"{word()}-{word()}"
        if habit == "three words or more with hyphens":
            return "-".join(word() for _ in range(rng.choice([3, 3, 4])))
        if habit == "digits after a word":
            return f"{word()}{rng.choice(['', '-'])}{rng.randrange(1, 9999)}"
        if habit == "digits among letters":
            return "".join(rng.choice("0134579") if rng.random() < 0.3 else c for c in word() + word())
        if habit == "letters that cannot be spoken":
            return "".join(rng.choice("bcdfghjklmnpqrstvwxz0123456789") for _ in range(rng.randrange(9, 22)))
        if habit == "a numeric address":
            return ".".join(str(rng.randrange(1, 255)) for _ in range(4))
        return ".".join([word() for _ in range(rng.choice([2, 3]))] + [f"{word()}-{word()}"])

    out = []
    for i in range(n):
        label = i % 2
        habit = rng.choices([h[0] for h in HABITS], [h[1] if label else h[2] for h in HABITS])[0]
        host = name(habit)
        if habit != "a numeric address":
            host = rng.choice(["", "", "www.", "www.", "m.", "blog.", "shop."]) + host + rng.choice([".com", ".org", ".net", ".info", ".co.uk", ".de", ".example.com", ".example.org", ".example.net"])
        tail = rng.choice(["", "/", f"/{word()}", f"/en/{rng.randrange(999)}", f"/{word()}/{word()}.html", f"/{word()}?p={rng.randrange(99)}", f"/{rng.randrange(2000, 2026)}/{word()}-{word()}"])
        if label and rng.random() < 0.15:
            tail = rng.choice([f"/{word()}.exe", f"/{word()}{rng.randrange(99999)}/login.php", f"/click/{rng.randrange(10**7)}"])
        out.append((f"http{rng.choice(['', 's'])}://{host}{tail}", label))
    return tuple(out)


BUCKETS = 1 << 14
SIZES = (1, 2, 3)


def host_path(url: str | Column = "url") -> tuple[Column, Column]:
    """Host (after the first ://, up to / ? # or the end, A-Z lower-cased) and path (then up to ? # or the end).

    Null, or no ://: both empty.
    """
    u = F.col(url) if isinstance(url, str) else url
    at = F.locate("://", u)
    rest = F.when(at > 0, u.substr(at + 3, F.length(u))).otherwise(F.lit(""))
    rest = F.coalesce(rest, F.lit(""))
    bare = F.regexp_extract(rest, r"(?s)^([^?#]*)", 1)
    host = F.regexp_extract(bare, r"(?s)^([^/]*)", 1)
    ascii_lower = F.translate(host, "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return ascii_lower, bare.substr(F.length(host) + 1, F.length(bare))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits: host or a subdomain of it, and a path prefix; else nulls."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    # shortest first, so that longer ones are asked before
    for h, p, v in sorted(rules, key=lambda r: (len(r[0]) + len(r[1]), r)):
        fits = ((host == h) | host.endswith("." + h)) & path.startswith(p)
        rule, verdict = F.when(fits, F.lit(h + p)).otherwise(rule), F.when(fits, F.lit(v)).otherwise(verdict)
    return rule, verdict


def _grams(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Row and bucket of each character n-gram of each text (bytes, framed by the text itself)."""
    rows, buckets = [], []
    for a, _, data, offs in slices(texts):
        p = prefix_hash(data)
        row_of = np.searchsorted(offs, np.arange(len(data)), "right") - 1
        for k in SIZES:
            start = np.arange(max(0, len(data) - k + 1))
            start = start[start + k <= offs[row_of[start] + 1]]
            rows.append(row_of[start] + a)
            buckets.append((span_hash(p, start, start + k) % np.uint64(BUCKETS)).astype(np.int64))
    z = np.zeros(0, np.int64)
    return (np.concatenate(rows), np.concatenate(buckets)) if rows else (z, z)


def framed(host: Column, path: Column) -> tuple[Column, Column]:
    """Host and path with marks at their ends, so that grams at an edge are others than those inside."""
    return F.concat(F.lit("^"), host, F.lit("$")), F.concat(F.regexp_replace(F.regexp_replace(path, "/+", "/"), "/$", ""), F.lit("|"))


def _framed(host: str, path: str) -> tuple[str, str]:
    """framed() of one url."""
    return f"^{host}$", re.sub("/$", "", re.sub("/+", "/", path)) + "|"


def _split(url: str) -> tuple[str, str]:
    rest = url.partition("://")[2].split("?")[0].split("#")[0]
    h, s, p = rest.partition("/")
    return h.lower(), s + p


class UrlModel:
    """Logistic regression on the set of hashed grams of a url (each of value 1 / sqrt(set size)); grams of the path have buckets of their own."""

    def __init__(self, labelled: tuple[tuple[str, int], ...], rounds: int = 400, rate: float = 15.0, ridge: float = 3e-5) -> None:
        hosts, paths = zip(*(_framed(*_split(u)) for u, _ in labelled), strict=True)
        x = self.features(pa.array(hosts, pa.large_string()), pa.array(paths, pa.large_string()))
        y = np.array([v for _, v in labelled], dtype=np.float64)
        self.w, self.b = np.zeros(2 * BUCKETS), 0.0
        rows, cols, vals = x
        for _ in range(rounds):
            g = self.score_of(x, len(y)) - y
            grad = np.bincount(cols, weights=vals * g[rows], minlength=2 * BUCKETS) / len(y)
            self.w -= rate * (grad + ridge * self.w)
            self.b -= rate * g.mean()

    @staticmethod
    def features(host: pa.Array, path: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, bucket, value) of the grams of hosts and paths made by framed()."""
        keys = []
        for part, texts in enumerate((host, path)):
            rows, buckets = _grams(texts)
            keys.append(np.unique(rows * (2 * BUCKETS) + part * BUCKETS + buckets))
        rows, cols = np.divmod(np.concatenate(keys), 2 * BUCKETS)
        size = np.bincount(rows, minlength=len(host))
        return rows, cols, 1 / np.sqrt(size[rows])

    def score_of(self, x: tuple[np.ndarray, np.ndarray, np.ndarray], n: int) -> np.ndarray:
        rows, cols, vals = x
        return 1 / (1 + np.exp(-(np.bincount(rows, weights=vals * self.w[cols], minlength=n) + self.b)))

    def score(self, host: pa.Array, path: pa.Array) -> np.ndarray:
        """Of hosts and paths made by framed()."""
        return self.score_of(self.features(host, path), len(host))


def judge_urls(pages: DataFrame, url: str = "url", rules=RULES, labelled: tuple[tuple[str, int], ...] | None = None, threshold: float = 0.5) -> DataFrame:
    """pages' page_id with host, path, rule, verdict and score (the classifier's probability of block); labelled: (url, 1 for
    block), see labelled_urls().

    A rule's verdict stands; without one, block if score >= threshold.  Null urls and urls without ://
    have empty host and path and get the classifier's verdict on that; nothing is dropped, repeated
    rows are judged alike, an empty table gives an empty result.  Columns beside page_id and url are ignored.
    """
    model = UrlModel(labelled_urls() if labelled is None else labelled)
    host, path = host_path(url)
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    parsed = pages.select("page_id", host.alias("host"), path.alias("path")).select("page_id", "host", "path", rule.alias("rule"), verdict.alias("ruled"), *[c.alias(n) for c, n in zip(framed(F.col("host"), F.col("path")), ("of_host", "of_path"), strict=True)])
    schema = pa.schema([("page_id", pa.int64()), ("host", pa.string()), ("path", pa.string()), ("rule", pa.string()), ("ruled", pa.string()), ("score", pa.float64())])

    def scored(it: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rb in it:
            for a in range(0, rb.num_rows, 4096):
                part = rb.slice(a, 4096)
                s = model.score(part.column("of_host"), part.column("of_path"))
                yield batch(schema, [part.column(c).cast(t) for c, t in zip(schema.names[:-1], schema.types[:-1], strict=True)] + [s])

    out = parsed.mapInArrow(scored, "page_id long, host string, path string, rule string, ruled string, score double")
    return out.withColumn("verdict", F.coalesce("ruled", F.when(F.col("score") >= threshold, "block").otherwise("allow"))).select("page_id", "host", "path", "rule", "verdict", "score")
