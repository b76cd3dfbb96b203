"""URL filters: rules by host and path, and a logistic regression on hashed character n-grams for the rest."""

from __future__ import annotations

from collections.abc import Iterable
from functools import cache

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The labelled table. Addresses are made up of common words; unwanted ones are of the kinds that blocklists
# name (gambling, adult, pharmacy, advertising and tracking, link farms, loans, replicas, downloads).
UNWANTED = """
casinoroyal.test/slots casino-bonus.test/en/1 bestcasino.test/ online-casino.test/play/77 casinos.test/de/5 mycasino-club.test/promo
pokerstars-bonus.test/poker poker-room.test/table/9 slots-jackpot.test/spin jackpotcity.test/win win-big.test/now lucky-win.test/fr/12
lotto-winner.test/prize betting-tips.test/odds bets-online.test/live sportbet.test/match/3 free-bet.test/offer bet365x.test/es/4 bets4you.test/
roulette-win.test/game bingo-free.test/room adult-video.test/watch adultfriends.test/join adult-chat.test/room/8 xxx-tube.test/v/123
xxx-movies.test/hd sexcams.test/live sex-dating.test/girls porn-free.test/video/55 pornhubby.test/ nude-pics.test/gallery hot-girls.test/cam
escort-city.test/vip x-rated.test/clips adult-toys.test/shop cheap-viagra.test/buy viagra-online.test/order cialis-pills.test/cheap
pills-online.test/rx pill-shop.test/order/2 diet-pills.test/sale cheap-meds.test/pharmacy pharmacy-discount.test/pills rx-pharma.test/buy
weight-loss-pills.test/ cheap-pharma.test/en/3 buy-pills-cheap.test/de/9 steroids-shop.test/buy ads-server.test/click adserver.test/banner/3
ad-tracker.test/pixel track-ads.test/event/7 adsclick.test/redirect popads.test/pop tracking-pixel.test/t click-track.test/c/99
tracker-stats.test/hit banner-ads.test/show trackads.test/en/8 adtrack.test/beacon ads-network.test/fr/2 spam-links.test/page
spammers.test/list/4 link-farm.test/out seo-farm.test/backlinks linkfarm.test/buy content-farm.test/en/31 spamblog.test/post/6
farm-links.test/dir backlink-spam.test/x spamsite.test/de/14 spam-mail.test/send payday-loan.test/apply fast-loans.test/cash
easy-credit-loans.test/now loan-shark.test/quick replica-watches.test/rolex fake-rolex.test/buy cheap-replica.test/bags
warez-download.test/crack crack-keygen.test/serial free-keygen.test/dl torrent-crack.test/full get-rich-quick.test/ make-money-fast.test/join
free-iphone.test/claim free-gift-cards.test/win prize-claim.test/free cheap-tickets-spam.test/deal crypto-doubler.test/invest
bitcoin-bets.test/dice miracle-cure.test/buy hot-deals-cheap.test/sale work-from-home-cash.test/apply
""".split()
WANTED = """
library.test/catalog/12 city-library.test/en/3 museum.test/exhibits university.test/research/55 stateuniversity.test/de/7 science-daily.test/article/9
nature-journal.test/paper/31 news.test/politics/2024 morningnews.test/en/8811 daily-times.test/world herald.test/sports/4 weather-report.test/today
blog.gardening.test/roses kitchen-recipes.test/soup/18 cooking.test/fr/31 baking-bread.test/sourdough travel-guide.test/spain/madrid
trains.test/timetable railway-museum.test/steam/2 airport.test/arrivals maps.test/route/5 hiking-trails.test/alps school.test/teachers
primary-school.test/en/17 math-lessons.test/algebra/3 physics.test/lectures/12 history-archive.test/1914 archive.test/item/9911 encyclopedia.test/wiki/Rome
dictionary.test/es/palabra grammar.test/verbs translation-forum.test/thread/7 forum.test/topic/42 m.forum.test/topic/43 www.community.test/post/88
opensource.test/project/docs docs.python-guide.test/tutorial code-review.test/pull/6 linux-kernel.test/patches database-notes.test/sql software.test/manual
hospital.test/departments health-service.test/flu doctor-finder.test/city/3 medicine-journal.test/vol/2 nursing.test/guidelines dentist.test/appointments
law-reports.test/case/51 court.test/decisions parliament.test/debates/77 government.test/forms/12 city-council.test/minutes tax-office.test/help
bank.test/branches insurance.test/contact accounting-basics.test/en/4 economics.test/paper/9 statistics-office.test/tables/3 market-report.test/grain
farm-museum.test/tractors organic-farm.test/vegetables farmers-weekly.test/harvest/6 sheepfarm.test/wool tracks-and-fields.test/running adventure.test/kayak
windsurfing.test/lessons winter-sports.test/ski wine-region.test/vineyards birdwatch.test/species/201 zoo.test/animals/lion astronomy.test/telescopes
music-school.test/piano orchestra.test/concerts/8 theatre.test/program/2 film-festival.test/2023 art-gallery.test/painters poetry.test/en/77 novel-reviews.test/b/5
bookshop.test/fiction bicycle-repair.test/gears car-manual.test/engine/3 woodworking.test/chairs knitting.test/patterns/66 garden-tools.test/spade
photography.test/lenses chess-club.test/openings football-club.test/team/1 swimming.test/times local-history.test/fr/19 genealogy.test/families
language-course.test/de/22 kindergarten.test/menu parents-forum.test/en/5 recipe-box.test/cake/4 tea-house.test/green coffee-roasters.test/beans
hotel-review.test/rooms camping.test/sites lighthouse.test/visit harbor.test/ships river-guide.test/maps/2 mountain-huts.test/es/8 volcano.test/iceland
thesaurus.test/en/901 the-reader.test/essay/14 thinkers.test/plato thermal-baths.test/hours theory.test/sets stationery.test/paper nationalpark.test/trails
relationship-advice.test/q/4 international.test/treaties translation.test/fr/2 invention-history.test/steam threads.test/sewing other-voices.test/radio
""".split()

#: Shortest and longest n-gram, and the number of hashed weights.
GRAMS, WEIGHTS = (3, 5), 1 << 14

#: (host, path) with its verdict, the form of ``rules``.
RULES = (("org", "/", "allow"), ("example.org", "/es/", "block"), ("example.org", "/en/1", "block"), ("com", "/fr/", "allow"), ("com", "/de/", "block"))


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host: after the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; path: then up to ``?``, ``#`` or the end.
    Both are empty where there is no ``://``, or no url."""
    rest = F.when(F.instr(url, "://") > 0, F.substring(url, F.instr(url, "://") + 3, F.length(url)))
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    host = F.translate(F.regexp_extract(rest, r"(?s)^([^/?#]*)", 1), upper, lower)
    return F.coalesce(host, F.lit("")), F.coalesce(F.regexp_extract(rest, r"(?s)^[^/?#]*([^?#]*)", 1), F.lit(""))


def rule_for(host: Column, path: Column, rules: Iterable[tuple[str, str, str]] = RULES) -> Column:
    """Struct (rule, verdict) of the longest rule that fits, or null; of equally long ones the first by code points.

    A rule fits its host and all below it where the path starts with the rule's. ``rules`` is a short list written into the plan.
    """
    found = F.lit(None).cast("struct<rule:string,verdict:string>")
    for rule_host, rule_path, verdict in sorted(rules, key=lambda r: (len(r[0] + r[1]), [-ord(c) for c in r[0] + r[1]])):
        fits = ((host == rule_host) | host.endswith(f".{rule_host}")) & path.startswith(rule_path)
        found = F.when(fits, F.struct(F.lit(rule_host + rule_path).alias("rule"), F.lit(verdict).alias("verdict"))).otherwise(found)
    return found


def gram_ids(host: str, path: str) -> np.ndarray:
    """Hashed ids of the distinct n-grams of host and path, marked by which of both they come from."""
    found = set()
    for mark, text in (("h", host), ("p", path)):
        text = f"^{text}$"
        for n in range(GRAMS[0], GRAMS[1] + 1):
            found.update(mark + text[i:i + n] for i in range(len(text) - n + 1))
    return np.array(sorted({xxhash.xxh64_intdigest(g.encode("utf-8", "surrogatepass")) % WEIGHTS for g in found}), dtype="int64")


@cache
def fit_urls(share: float = 0.25, rounds: int = 1000, step: float = 1.0, shrink: float = 1e-5) -> np.ndarray:
    """Weights (the last one is the constant) of a logistic regression, by gradient descent on the labelled table.

    Addresses count as unit vectors of their n-grams; unwanted ones are taken to be the given ``share`` of a crawl. Labelled hosts also stand
    below ``www.`` and ``m.``, so that these prefixes say nothing. ``shrink`` has the least log loss in cross-validation on the table.
    """
    rows, labels = [], []
    for table, label in ((UNWANTED, 1.0), (WANTED, 0.0)):
        for address in table:
            host, _, path = address.partition("/")
            name = host.removesuffix(".test")
            for form in (f"{name}.com", f"www.{name}.net", f"m.{name}.org"):
                rows.append(gram_ids(form, f"/{path}"))
                labels.append(label)
    y = np.array(labels)
    balance = np.where(y == 1, share / y.sum(), (1 - share) / (1 - y).sum())
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    ids, value = np.concatenate(rows), np.repeat([len(r) ** -0.5 for r in rows], [len(r) for r in rows])
    weights = np.zeros(WEIGHTS + 1)
    for _ in range(rounds):
        margin = np.bincount(at, weights[ids] * value, len(rows)) + weights[-1]
        error = balance * (1 / (1 + np.exp(-margin)) - y)
        slope = np.bincount(ids, error[at] * value, WEIGHTS)
        weights[:-1] -= 50 * step * (slope + shrink * weights[:-1])
        weights[-1] -= step * error.sum()
    return weights


def unwanted(host: str, path: str, weights: np.ndarray) -> float:
    """Probability that an address is unwanted. Without host and path it is 0."""
    if not host and not path:
        return 0.0
    ids = gram_ids(host, path)
    return float(1 / (1 + np.exp(-(weights[ids].sum() * len(ids) ** -0.5 + weights[-1]))))


def judge_urls(pages: DataFrame, rules: Iterable[tuple[str, str, str]] = RULES, threshold: float = 0.5) -> DataFrame:
    """``pages`` with ``host, path, rule, score, verdict``: the verdict of the longest fitting rule, else ``block`` where the model's
    score is ``threshold`` or more and ``allow`` below.

    A map without shuffle: rules are expressions; the model scores whole host and path in Arrow batches, only where no rule
    fits (``score`` is null elsewhere). A null url or one without ``://`` has empty host and path, and is allowed with score 0. Repeated rows
    are judged each; an empty table gives no rows. Columns of ``pages`` with one of these names are replaced.
    """
    weights = fit_urls()

    @F.pandas_udf("double")
    def score(hosts: pd.Series, paths: pd.Series) -> pd.Series:
        return pd.Series([None if h is None else unwanted(h, p, weights) for h, p in zip(hosts, paths)], dtype="float64")

    host, path = host_and_path(F.col("url"))
    named = pages.withColumns({"host": host, "path": path}).withColumn("__rule", rule_for(F.col("host"), F.col("path"), rules))
    open_host = F.when(F.col("__rule").isNull(), F.col("host"))
    scored = named.withColumn("score", score(open_host, F.col("path")))
    scored = scored.withColumn("score", F.when(F.col("__rule").isNull(), F.col("score")))  # Arrow has NaN for null
    verdict = F.coalesce("__rule.verdict", F.when(F.col("score") >= threshold, "block").otherwise("allow"))
    return scored.withColumns({"rule": F.col("__rule.rule"), "verdict": verdict}).drop("__rule")
