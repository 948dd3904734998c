"""The URL judge: what the suffix share looks at, verdicts on URLs it never read labels of, odd rows, host and path in SQL."""

import duckdb
import numpy as np
from pyspark.sql import functions as F

from lexigrove.llm import urls
from lexigrove.llm.catalog import URL_RULES, op9_urls


def test_share_never_holds_the_own_label(spark):
    """Of two equal tables in which one URL's label differs, that URL has the same share."""
    def share(label):
        rows = [(i, "ab"[i % 2], i % urls.FOLDS, urls.BLOCK if i % 3 else urls.ALLOW) for i in range(40)] + [(99, "a", 2, label)]
        known = spark.createDataFrame(rows, "page_id long, suffix string, fold int, ruled string")
        counts = urls._suffix_counts(known, (F.col("ruled") == urls.BLOCK).cast("double"))
        found = known.join(counts, "suffix").select("page_id", "suffix", "fold", urls._suffix_share(0.5).alias("share")).collect()
        by_hand = {}
        for _, suffix, fold, _ in rows:
            others = [r[3] for r in rows if r[1] == suffix and r[2] != fold]
            by_hand[suffix, fold] = (others.count(urls.BLOCK) + 2.5) / (len(others) + 5)
        assert all(abs(r.share - by_hand[r.suffix, r.fold]) < 1e-12 for r in found)
        return next(r.share for r in found if r.page_id == 99)

    assert share(urls.BLOCK) == share(urls.ALLOW)


def test_held_out_verdicts(spark):
    """Labels come from rules on half of the hosts; the kinds of URL on the other hosts are told by their form."""
    draw = np.random.default_rng(8)
    rows = []
    for i in range(1200):
        bad, ruled = i % 2, i // 2 % 2
        host = f"{'r' if ruled else 'n'}{draw.integers(50)}.{'known' if ruled else 'other'}{bad}.xx"
        path = f"/{draw.integers(10**9)}/{draw.integers(10**9)}?a=1&b=2&c=3" if bad else "/guide/" + "".join(draw.choice(list("abcdefgh"), 8))
        rows.append((i, f"https://{host}{path}"))
    rules = [urls.Rule(urls.BLOCK, "known1.xx/"), urls.Rule(urls.ALLOW, "known0.xx/")]
    found = urls.judge(spark.createDataFrame(rows, "page_id long, url string"), rules).collect()
    unruled = [r for r in found if r.rule is None]
    assert len(found) == 1200 and len(unruled) == 600
    assert np.mean([(r.verdict == urls.BLOCK) == bool(r.page_id % 2) for r in unruled]) > 0.97


def test_odd_rows(spark):
    rows = [(1, None, "x"), (2, "", "x"), (3, "no scheme", "x"), (4, "http://a.com/de/" + "q" * 200_000, "x"), (5, "http://A.ORG/é?#", "x"),
            (5, "http://A.ORG/é?#", "x"), (None, "http://b.com/fr/1", None)]
    pages = spark.createDataFrame(rows, "page_id long, url string, suffix string").withColumns({"fold": F.lit("f"), "rows": F.lit(1), "ruled": F.lit(2)})
    found = urls.judge(pages, URL_RULES).collect()
    assert len(found) == 7 and all(r.verdict in (urls.ALLOW, urls.BLOCK) for r in found)
    assert {(r.host, r.path) for r in found if r.page_id in (1, 2, 3)} == {("", "")}
    assert {r.rule for r in found if r.page_id == 4} == {"com/de/"} and {r.host for r in found if r.page_id == 5} == {"a.org"}


def test_host_path_and_rule_by_sql(spark, sf_dir):
    ours = {(r.page_id, r.host, r.path, r.rule) for r in op9_urls(spark, sf_dir).collect()}
    theirs = duckdb.sql(f"""
        WITH s AS (SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN url[instr(url, '://') + 3:] ELSE '' END AS rest FROM '{sf_dir}/pages.parquet'),
        h AS (SELECT page_id, regexp_extract(rest, '^[^/?#]*') AS raw, rest FROM s),
        p AS (SELECT page_id, lower(raw) AS host, regexp_extract(rest[length(raw) + 1:], '^[^?#]*') AS path FROM h),
        r AS (SELECT unnest(['org/', 'example.org/es/', 'example.org/en/1', 'com/fr/', 'com/de/']) AS rule)
        SELECT page_id, host, path, (SELECT arg_max(rule, length(rule)) FROM r WHERE (host = split_part(rule, '/', 1)
          OR ends_with(host, '.' || split_part(rule, '/', 1))) AND starts_with(path, rule[instr(rule, '/'):])) FROM p""").fetchall()
    assert ours == set(theirs)
