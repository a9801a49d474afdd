"""URL filter: rules against plain Python, trees on labelled URLs they have not seen."""

import re

import numpy as np
import pyarrow as pa
import pytest

from seqprep.llm import url_filter
from seqprep.sources.package import ship_package

URLS = [
    "http://a.com/x", "http://A.CoM/x", "http://com", "http://com?x", "http://com/", "http://xcom/", "http://a.xcom/",
    "http://example.com/en/1", "http://m.example.com/en/1", "http://example.com/EN/1", "http://example.com/en",
    "https://www.example.com/en/", "https://www.m.example.com/en/", "https://m.www.example.com/en/?a=http://net/es/",
    "http://x.net/es/1", "http://x.net/fr/#a", "http://x.net/de/", "http://x.net?/es/", "http://net/es/",
    "net/es/", "//net/es/", "://net/es/", "http://net#/es/", "http://net\n/es/", "http://x.net/es/a://com/", "http://",
    "", None, "http://é.com/É?É", "HTTP://ÉX.COM/", "http://u@a.com:80/x",
]


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url[url.index("://") + 3 :]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host) :]).group()
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def expected_rule(url):
    host, path = parts(url)
    fit = [r for r in url_filter.RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    return max(fit, key=lambda r: len(r.text), default=None)


def test_host_path_and_longest_rule(spark):
    rows = [(i, u, "h", "p", "r", "v", 1.5, "x") for i, u in enumerate(URLS + URLS[:3])]
    schema = "page_id long, url string, host string, path string, rule string, verdict string, score double, ruled string"
    ship_package(spark)
    model = url_filter.train(spark.createDataFrame([], "url string, label int"))
    found = url_filter.judge(spark.createDataFrame(rows, schema).repartition(3), model).collect()
    assert len(found) == len(rows)
    for r in found:
        rule = expected_rule(r["url"])
        assert (r["host"], r["path"]) == parts(r["url"]), r["url"]
        assert r["rule"] == (rule and rule.text), r["url"]
        assert r["verdict"] == (rule.verdict if rule else "block") and r["score"] == 0.5


def test_rules_of_one_length_and_none(spark):
    rules = [url_filter.Rule("block", "b.com/xy"), url_filter.Rule("allow", "a.b.com/")]
    urls = spark.createDataFrame([("http://a.b.com/xy",), ("http://b.com/xy",)], "url string")
    assert [r["ruled"] for r in url_filter.with_rules(urls, rules).collect()] == ["allow", "block"]
    assert [r["rule"] for r in url_filter.with_rules(urls, []).collect()] == [None, None]


def labelled(count, seed):
    """Blocked: many parameters, or hosts of hyphens and digits; a tenth of the labels of one suffix is noise."""
    random = np.random.default_rng(seed)
    rows = []
    for _ in range(count):
        host = "".join(random.choice(list("abcdefgh"), 8))
        bad = random.random() < 0.4
        if bad and random.random() < 0.5:
            host = f"{host[:3]}-{random.integers(1000, 99999)}-{host[3:]}"
            query = ""
        else:
            query = "?" + "&".join(f"k{i}={random.integers(99)}" for i in range(random.integers(4, 9) if bad else random.integers(0, 3)))
        rows.append((f"https://{host}.{random.choice(['org', 'net'])}/{'d/' * random.integers(1, 4)}p.html{query}", int(bad)))
    return rows


def test_trees_learn_lexical_labels(spark):
    ship_package(spark)
    known, unseen = labelled(1500, 1), labelled(700, 2)
    train = known + [(None, 1), ("http://x.org/", None)] + known[:20]
    model = url_filter.train(spark.createDataFrame(train, "url string, label int").repartition(5))
    again = url_filter.train(spark.createDataFrame(train[::-1], "url string, label int").repartition(2))
    assert (model.trees.limits == again.trees.limits).all() and (model.trees.leaves == again.trees.leaves).all()
    judged = url_filter.judge(spark.createDataFrame(unseen, "url string, label int").repartition(3), model, rules=()).collect()
    assert sum((r["verdict"] == "block") == r["label"] for r in judged) / len(judged) > 0.95
    assert all(0 <= r["score"] <= 1 and (r["verdict"] == "block") == (r["score"] >= 0.5) for r in judged)


def test_one_label_only(spark):
    ship_package(spark)
    model = url_filter.train(spark.createDataFrame([(f"http://x.org/{i}", 0) for i in range(50)], "url string, label int"))
    judged = url_filter.judge(spark.createDataFrame([("http://y.org/",), (None,)], "url string"), model, rules=())
    assert [r["verdict"] for r in judged.collect()] == ["allow", "allow"]
    assert url_filter.judge(spark.createDataFrame([], "url string"), model).collect() == []


def test_trees_equal_a_walk_from_node_to_node():
    random = np.random.default_rng(5)
    rows = random.normal(size=(900, 4)).round(1)
    labels = ((rows[:, 0] > 0.3) ^ (rows[:, 2] > 0)).astype(float)
    trees = url_filter.fit_trees(rows, labels, trees=12, depth=3)
    assert ((trees.score(rows) >= 0.5) == labels).mean() > 0.9
    for row, found in list(zip(rows, trees.logit(rows)))[:60]:
        total = trees.base
        for features, limits, leaves in zip(trees.features, trees.limits, trees.leaves):
            node = 0
            while node < len(features):
                node = 2 * node + (1 if row[features[node]] <= limits[node] else 2)
            total += leaves[node - len(features)]
        assert found == pytest.approx(total)


@pytest.mark.parametrize("piece", [1, 7, 1 << 18])
def test_byte_counts(monkeypatch, piece):
    monkeypatch.setattr(url_filter, "PIECE_BYTES", piece)
    texts = ["ab", None, "", "zé0", "a" * 50, ""]
    for array in (pa.array(texts), pa.array(["x", *texts]).slice(1)):
        found = url_filter.byte_counts(array.cast(pa.large_string()))
        expected = [np.bincount(list((t or "").encode()), minlength=256) if t else np.zeros(256) for t in texts]
        assert (found == np.array(expected)).all()


def test_very_long_url(spark):
    ship_package(spark)
    model = url_filter.train(spark.createDataFrame(labelled(300, 3), "url string, label int"))
    long = "http://x.net/es/" + "a1-" * 1_500_000 + "?x=1"
    row = url_filter.judge(spark.createDataFrame([(long,)], "url string"), model).select("host", "rule", "verdict").first()
    assert tuple(row) == ("x.net", "net/es/", "block")
