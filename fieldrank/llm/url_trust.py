"""URL filter by link-graph propagation of trust and distrust.

Rules (host and path prefix) judge the urls they fit; the longest rule wins. For all other
urls the host's place in the link graph decides. Pages give host edges: absolute link
targets and host names in the page's imprint (``LINKS``). Each host's urls seed it with
trust (allowed ones), distrust (blocked ones) or neither, one unit each. Trust and
neutral mass flow along the links, distrust against them (who links to a blocked host is
doubtful himself), as personalised PageRank:
``r = (1 - DAMPING) seed + DAMPING * sum over neighbours of r / degree``.

The verdict compares masses of the same walk that don't grow with a host's unjudged urls:
``bad`` and ``good`` are seeded by blocked and allowed urls times their share of the host's
urls (as likely a link to the host meets one), ``unsure`` by the share of unjudged urls; a
host's own urls count there by their shares, so they weigh as one url against what flows in.
A host is blocked when ``bad`` makes up ``BLOCK_SHARE`` or more of the three, else allowed.

Each round is one join and one aggregation over (direction, host) rows, written to the
shared folder; rounds end when no host's mass moves by more than the share ``TOLERANCE`` of
itself, so the rest of the corpus doesn't matter to a host's depth of propagation. They do
end: masses only grow, in steps of ``DIGITS`` digits, and fade by DAMPING with each link, so
rounds grow with the logarithm of the masses. Edges are counted per pair of hosts before
any shuffle, so a host that most pages link to or come from has at most one edge per other
host, and the rows of a page are only its id, host and path.

Defined results: a null url or one without ``://`` has empty host and path, fits no rule and
is allowed; a null html has no links; links of a host to itself and empty hosts count
nowhere; repeated pages count each for themselves; no pages give no rows; only id, url and
html are read. The masses given out are shares of all urls.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import ascii_lower, table, written

# Host, path, verdict.
RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
DAMPING, TOLERANCE, BLOCK_SHARE = 0.7, 1e-3, 0.5
#: What names another host in a page: the target of an absolute link, or the imprint.
LINKS = [r"""(?i)href *= *["']?(?:[a-z][a-z0-9+.-]*:)?//([^/?#"' >]+)""", r"&copy; ([A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+)"]
#: Masses are rounded to so many digits of a url.
DIGITS = 9
MASSES = ["r", "s", "v", "w"]


def host_and_path(url: Column) -> tuple[Column, Column]:
    """Host (A-Z lower-cased) and path of a url; both empty without ``://``."""
    url = F.coalesce(url, F.lit(""))
    at = F.instr(url, "://")
    rest = F.when(at > 0, F.substring(url, at + 3, F.length(url))).otherwise("")
    return ascii_lower(F.regexp_extract(rest, r"^([^/?#]*)", 1)), F.regexp_extract(rest, r"^[^/?#]*([^?#]*)", 1)


def rule_of(host: Column, path: Column, rules=RULES) -> tuple[Column, Column]:
    """The longest rule that fits (``host`` + ``path`` of the rule) and its verdict; nulls if none does."""
    ordered = sorted(rules, key=lambda r: (-len(r[0] + r[1]), r[0], r[1]))
    name = verdict = F.lit(None).cast("string")
    for h, p, v in reversed(ordered):
        fits = ((host == h) | F.endswith(host, F.lit("." + h))) & F.startswith(path, F.lit(p))
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, v).otherwise(verdict)
    return name, verdict


def host_edges(pages: DataFrame, links=LINKS) -> DataFrame:
    """(src, dst, n) links between different hosts; ``pages`` has host and html."""
    named = reduce(F.concat, [F.regexp_extract_all(F.coalesce("html", F.lit("")), F.lit(p), F.lit(1)) for p in links])
    found = pages.where("host <> ''").select(F.col("host").alias("src"), F.explode(named).alias("target"))
    found = found.select("src", ascii_lower(F.col("target")).alias("dst")).where("dst <> '' AND src <> dst")
    return found.groupBy("src", "dst").agg(F.count("*").alias("n"))


def spread(hosts: DataFrame, edges: DataFrame) -> DataFrame:
    """(host, trust, neutral, distrust) of all hosts that a seed reaches, in urls, and (good,
    unsure, bad) that the verdict compares. ``hosts``: host and its numbers of allowed,
    blocked and other urls."""
    forward = edges.select(F.lit(True).alias("along"), F.col("src").alias("host"), F.col("dst").alias("to"), "n")
    backward = edges.select(F.lit(False).alias("along"), F.col("dst").alias("host"), F.col("src").alias("to"), "n")
    both = written(forward.union(backward), "links")
    degree = both.groupBy("along", "host").agg(F.sum("n").alias("all"))
    flows = written(both.join(degree, ["along", "host"]).select("along", "host", "to", (F.col("n") / F.col("all")).alias("share")), "flows")
    # along the links r is trust, s neutral, v good and w unsure; against them r is distrust and v
    # bad. own: what takes the host's own urls in v from their number to their share
    urls, none = F.col("allowed") + F.col("blocked") + F.col("other"), F.lit(0.0)
    start = lambda way, r, s: F.struct(F.lit(way).alias("along"), *[((1 - DAMPING) * x).alias(c) for c, x in (
        ("r", r), ("s", s), ("v", r * r / urls), ("w", s / urls), ("own", r / urls - r * r / urls))])
    sides = F.array(start(True, F.col("allowed"), F.col("other")), start(False, F.col("blocked"), none))
    seeds = written(hosts.select("host", F.explode(sides).alias("x")).select("x.along", "host", "x.r", "x.s", "x.v", "x.w", "x.own").where("r + s > 0"), "seeds")
    fixed = seeds.select("along", "host", *MASSES)
    ranks = fixed
    while True:
        passed = DAMPING * F.col("share")
        moved = ranks.join(flows, ["along", "host"]).select("along", F.col("to").alias("host"), *[(passed * F.col(c)).alias(c) for c in MASSES])
        new = moved.union(fixed).groupBy("along", "host").agg(*[F.round(F.sum(c), DIGITS).alias(c) for c in MASSES])
        old = ranks.select("along", "host", *[F.col(c).alias(c + "0") for c in MASSES])
        moves = reduce(lambda x, y: x | y, [F.abs(F.col(c) - F.coalesce(c + "0", none)) > TOLERANCE * F.col(c) for c in MASSES])
        new = written(new.join(old, ["along", "host"], "left").select("along", "host", *MASSES, moves.alias("moves")), "ranks")
        ranks = new.select("along", "host", *MASSES)
        if new.where("moves").isEmpty():
            break
    zero = [none.alias(c) for c in MASSES if c != "v"]
    ends = ranks.unionByName(seeds.select("along", "host", F.col("own").alias("v"), *zero))
    return ends.groupBy("host").agg(*[F.round(F.sum(F.when(F.col("along") == way, F.col(c)).otherwise(0.0)), DIGITS - 1).alias(name) for name, way, c in (
        ("trust", True, "r"), ("neutral", True, "s"), ("distrust", False, "r"), ("good", True, "v"), ("unsure", True, "w"), ("bad", False, "v"))])


def judged(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html", rules=RULES, links=LINKS) -> DataFrame:
    """One row per page: page_id, host, path, rule, verdict, trust, neutral and distrust."""
    host, path = host_and_path(F.col(f"`{url}`").cast("string"))
    read = pages.select(F.col(f"`{page_id}`").alias("page_id"), host.alias("host"), path.alias("path"), F.col(f"`{html}`").cast("string").alias("html"))
    edges = written(host_edges(read, links), "host-edges")
    name, verdict = rule_of(F.col("host"), F.col("path"), rules)
    rows = read.drop("html").withColumns({"rule": name, "verdict": verdict})
    counted = [F.count(F.when(F.coalesce("verdict", F.lit("none")) == v, 1)).alias(c) for c, v in (("allowed", "allow"), ("blocked", "block"), ("other", "none"))]
    hosts = rows.where("host <> ''").groupBy("host").agg(*counted)
    total = hosts.agg(F.sum(F.col("allowed") + F.col("blocked") + F.col("other"))).first()[0] or 1  # one number
    out = rows.join(spread(hosts, edges), "host", "left")
    mass = F.round(BLOCK_SHARE * (F.col("good") + F.col("unsure") + F.col("bad")), DIGITS - 2)
    bad = F.coalesce((F.col("bad") > 0) & (F.round("bad", DIGITS - 2) >= mass), F.lit(False))
    return out.select("page_id", "host", "path", "rule", F.coalesce("verdict", F.when(bad, "block").otherwise("allow")).alias("verdict"),
                      *[F.round(F.coalesce(c, F.lit(0.0)) / total, 6).alias(c) for c in ("trust", "neutral", "distrust")])


def op1_url_trust(spark, sf_dir):
    return judged(table(spark, sf_dir, "pages"))
