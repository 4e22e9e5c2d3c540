"""URL filters: host and path rules, and a logistic regression on hashed character n-grams for the rest.

The regression is trained on a small labelled table of URLs (labelled(), or any other that is given) and broadcast
as one vector of fixed length. Rules, host and path are plain column expressions.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: (verdict, host, path): a rule holds for its host and all subdomains, and paths that begin with its path.
RULES = (("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/"))

#: Stems of the labelled table; no host of a given table is among them.
BLOCKED_STEMS = (
    "casino poker roulette blackjack jackpot slots bingo lottery lotto betting bet bets wager gambling sportsbook viagra cialis pills pill pharma meds steroids tramadol xanax "
    "slimming dietpill payday loan loans forex bitcoin crypto ponzi cash profit porn porno xxx sex sexy adult nude escort cams camgirl hentai milf hookup singles fetish warez "
    "torrent crack cracked keygen serialz nulled cheats replica rolex fake counterfeit spam spammer malware phish phishing trojan ransom hacked ads adserver advert banner popup "
    "popunder tracker track tracking pixel click clicks clickbait affiliate promo seo backlink backlinks linkfarm traffic followers likes giveaway prize winner sweepstake freebie bonus coupon cheap discount"
).split()
ALLOWED_STEMS = (
    "news blog docs wiki university library research archive science history garden kitchen recipe travel music school museum city weather health forum code developer manual guide "
    "journal press book map theory nature sport culture family energy language mathematics physics art photo theatre railway river station nation edition theorem thread northern "
    "leather brother translation other together anthology earth ninth shelter stone ribbon entrance times thought month length method growth path shore southern atlantic planet "
    "student content continent instant strategy statistic justice forest interest thousand sandwich island england standard handbook channel analysis finance parent event comment "
    "patent restaurant hotel maritime painting building thinking reading training evening action education foundation national international tradition solution opinion region union "
    "season lesson person village bridge mountain ocean animal bird flower tree food bread coffee tea cycling running football chess film cinema radio camera design paper "
    "letter poem novel author teacher doctor hospital dentist lawyer court council parliament minister police fire church temple bank market shop store house home street road "
    "transport bus train flight airport harbour ship boat car engine motor tool wood metal glass fabric fashion shoe hat clock lamp furniture chemistry biology geology astronomy space"
).split()
#: Both kinds of stems are put together with the same parts, so that a part tells nothing.
BEFORE = ("", "best", "my", "the", "top", "all", "go", "new", "mega", "net", "free", "one")
AFTER = ("", "s", "hub", "online", "world", "24", "zone", "page", "land", "club", "365", "center", "now", "point")
FORMS = 8
#: Paths of either kind; n is a number, word another of the same kind.
BLOCKED_PATHS = ("go/{n}", "click/{n}", "{word}/signup-bonus", "offer/{word}-{n}", "{word}/free-trial", "order-now/{n}", "vip/{word}", "download/{word}.exe", "live/{word}/join", "win/{n}", "deal/{word}", "{word}{n}")
ALLOWED_PATHS = ("2019/05/{word}", "about", "articles/{n}", "{word}.html", "docs/{word}/", "category/{word}/{n}", "tag/{word}", "wiki/{word}", "contact", "{word}/{n}/", "en/{word}-{n}.html", "{word}{n}")
NAMES = 600
BITS, NGRAMS = 16, (3, 4, 5)
EPOCHS, RATE, DECAY = 150, 0.05, 2e-6


def words(stems: list[str]) -> list[str]:
    """FORMS words of each stem: itself, and with parts before or after it."""
    out = {}
    for i, stem in enumerate(stems):
        for k in range(FORMS):
            n = i * FORMS + k
            before, after = (BEFORE[(7 * n) % len(BEFORE)] if k % 2 else ""), (AFTER[(5 * n) % len(AFTER)] if k % 4 != 1 and k else "")
            joint = "-" if n % 3 == 0 else ""
            out["".join((before and before + joint, stem, after and (joint if len(after) > 2 else "") + after))] = None
    return list(out)


def names(count: int = NAMES) -> list[str]:
    """Invented names of two or three syllables, as many sites have: nothing known speaks against them."""
    out = []
    for i in range(count):
        n = zlib.crc32(f"name {i}".encode())
        out.append("".join("bcdfghklmnprstvwz"[(n >> 8 * k) % 17] + "aeiou"[(n >> 8 * k + 4) % 5] + ("", "n", "r", "s", "l", "th")[(n >> 8 * k + 2) % 6] for k in range(2 + i % 2)))
    return out


def labelled(blocked: list[str] | None = None, allowed: list[str] | None = None) -> list[tuple[str, int]]:
    """The small labelled table: each word as a host under prefixes and domains, beside another of its kind, and as a path. 1 is to be blocked."""
    rows = []
    given = words(ALLOWED_STEMS) + names() if allowed is None else allowed
    for label, known, paths in ((1, words(BLOCKED_STEMS) if blocked is None else blocked, BLOCKED_PATHS), (0, given, ALLOWED_PATHS)):
        for i, word in enumerate(known):
            other = known[(i * 31 + 17) % len(known)]
            domain, plain = ("com", "org", "net")[i % 3], f"{('en', 'de', 'fr', 'es')[i % 4]}/{37 * i % 900}{('', '.html', '/', '?ref=x')[i // 4 % 4]}"
            rows += [
                (f"https://{('', 'www.', 'm.', 'blog.')[i % 4]}{word}.example.{domain}/{plain}", label),
                (f"http://{('www.', '')[i % 2]}{word}-{other}.example.{domain}/{paths[i % len(paths)].format(n=i, word=other)}", label),
                (f"https://www.site{i % 7}.example.{domain}/{word}/{paths[(i + 3) % len(paths)].format(n=i, word=other)}", label),
            ]
    return rows


def host_of(url: Column) -> Column:
    """From after the first :// to the next / ? # or the end, A-Z lower-cased; null or without :// empty."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.coalesce(F.translate(F.regexp_extract(url, r"(?s)^.*?://([^/?#]*)", 1), upper, lower), F.lit(""))


def path_of(url: Column) -> Column:
    """From after the host to the next ? # or the end."""
    return F.coalesce(F.regexp_extract(url, r"(?s)^.*?://[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits, else nulls."""
    best, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: len(r[1] + r[2])):
        fits = ((host == h) | host.endswith(f".{h}")) & path.startswith(p)
        best, verdict = F.when(fits, h + p).otherwise(best), F.when(fits, what).otherwise(verdict)
    return best, verdict


def features(host: str, path: str) -> set[int]:
    """Hashed n-grams: hosts and paths have spaces of their own."""
    out = set()
    for kind, text in ((b"h", f"^{host}$"), (b"p", f"^{path}$")):
        data = text.encode("utf-8", "replace")
        for n in NGRAMS:
            for i in range(len(data) - n + 1):
                out.add(zlib.crc32(kind + data[i : i + n]) & ((1 << BITS) - 1))
    return out


def split_url(url: str | None) -> tuple[str, str]:
    """host_of and path_of for one Python string."""
    _, mark, rest = (url or "").partition("://")
    if not mark:
        return "", ""
    end = min((i for i in map(rest.find, "/?#") if i >= 0), default=len(rest))
    host = rest[:end].translate({c: c + 32 for c in range(65, 91)})
    tail = rest[end:]
    return host, tail[: min((i for i in map(tail.find, "?#") if i >= 0), default=len(tail))]


def train(rows: list[tuple[str, int]]) -> tuple[np.ndarray, float]:
    """Weights (2 ** BITS) and bias, by Adam over the whole small table."""
    both = np.zeros((1 << BITS) + 1)
    if not rows:
        return both[:-1], 0.0
    sets = [np.fromiter(features(*split_url(u)), np.int64) for u, _ in rows]
    at, of = np.concatenate(sets), np.repeat(np.arange(len(sets)), [len(x) for x in sets])
    scale = 1 / np.sqrt(np.maximum(1, [len(x) for x in sets]))
    y = np.array([label for _, label in rows], float)
    share = 1 / len(y)
    first, second = np.zeros_like(both), np.zeros_like(both)
    for step in range(1, EPOCHS + 1):
        z = np.bincount(of, both[at], len(rows)) * scale + both[-1]
        error = (1 / (1 + np.exp(-z)) - y) * share
        slope = np.append(np.bincount(at, (error * scale)[of], 1 << BITS), error.sum()) + DECAY * np.append(both[:-1], 0)
        first, second = 0.9 * first + 0.1 * slope, 0.999 * second + 0.001 * slope * slope
        both -= RATE * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-9)
    return both[:-1], float(both[-1])


@lru_cache(maxsize=4)
def _default() -> tuple[np.ndarray, float]:
    return train(labelled())


def judge(pages: DataFrame, rules=RULES, rows: list[tuple[str, int]] | None = None, id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """One row for each input row: the id, host, path, rule, verdict, score.

    Null urls and those without :// have empty host and path, no rule, and the regression's verdict on empty text.
    score is the regression's probability that the URL is to be blocked, also where a rule decides. Repeated rows
    give repeated rows; an empty table none; other columns are ignored.
    """
    weights, bias = _default() if rows is None else train(rows)
    weights = weights.astype(np.float32)

    @F.pandas_udf("double")
    def score(parts: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for hosts, paths in parts:
            out = []
            for host, path in zip(hosts, paths, strict=True):
                at = np.fromiter(features(host, path), np.int64)
                z = float(weights[at].sum()) / max(1.0, np.sqrt(len(at))) + bias
                out.append(1 / (1 + np.exp(-z)))
            yield pd.Series(out, dtype="float64")

    split = pages.select(F.col(id_col).alias("page_id"), host_of(F.col(url_col)).alias("host"), path_of(F.col(url_col)).alias("path"))
    rule, verdict = rule_of(F.col("host"), F.col("path"), rules)
    scored = split.select("page_id", "host", "path", rule.alias("rule"), verdict.alias("_ruled"), score("host", "path").alias("score"))
    decided = F.coalesce(F.col("_ruled"), F.when(F.col("score") >= 0.5, "block").otherwise("allow"))
    return scored.select(F.col("page_id").alias(id_col), "host", "path", "rule", decided.alias("verdict"), "score")
