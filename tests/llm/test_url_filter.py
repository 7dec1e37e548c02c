from __future__ import annotations

import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import types as T

from check import compare, duck
from sparkwh.llm import url_filter as uf
from sparkwh.llm.batches import text_bytes
from sparkwh.llm.queries import RULES
from tests.llm.helpers import SF

PAGES = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                      *(T.StructField(c, T.StringType()) for c in ("host", "path", "rule", "verdict", "canonical"))])


def plain(url):
    """The contract, without an automaton."""
    at = (url or "").find("://")
    rest = "" if at < 0 else url[at + 3:]
    host = re.match(r"[^/?#]*", rest).group()
    path = re.match(r"[^?#]*", rest[len(host):]).group()
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fit = [r for r in RULES if (host == r.host or host.endswith("." + r.host)) and path.startswith(r.path)]
    best = max(fit, key=lambda r: len(r.name), default=None)
    return host, path, best.name if best else None, best.verdict if best else "allow"


def as_regex(glob):
    out = ""
    for part in re.split(r"(\*\*|\*|\?)", glob):
        out += {"**": "(?s:.*)", "*": r"[^/]*", "?": r"[^/]"}.get(part, re.escape(part))
    return re.compile(out)


def test_query_agrees_with_sql(spark):
    good, note = compare(spark, duck(SF), "op12_url_filter", SF)
    assert good and "TYPES" not in note, note


def test_odd_urls(spark):
    urls = [None, "", "no mark", "://", "http://", "http:///x", "http://NET", "http://a.NET/", "http://net/", "http://anet/", "http://net?x/",
            "http://a.net/en/", "https://www.Example.net/en/x", "https://example.net/EN/x", "https://example.net/en", "a://b://c.net/",
            "http://example.com/de/?q", "http://example.com/x/.example.com/de/", "http://x.org/fr/#a", "http://org/fr/", "http://u@a.net/",
            "http://a.net:80/", "http://a.b/x.net/en/", "http://ÄÖ.net/ü", "http://a.net\n/x", "http://日本.org/fr/é", "http://K.org/fr/",
            "http://" + "a." * 200_000 + "net/", "http://x.net/" + "y" * 300_000, "http://a.net/", "http://a.net/"]
    urls += [f"http://h{i}.example.net/en/{i}" for i in range(50)]
    rows = [(k, u, *"xxxxx") for k, u in enumerate(urls)] + [(None, "http://a.net/", *"xxxxx")]
    got = uf.judged(spark.createDataFrame(rows, PAGES).repartition(3), RULES).collect()
    assert sorted(map(tuple, got), key=repr) == sorted(((r[0], *plain(r[1])) for r in rows), key=repr)
    assert uf.judged(spark.createDataFrame([], PAGES), RULES).collect() == []


@pytest.mark.parametrize("seed", range(6))
def test_automaton_agrees_with_regular_expressions(seed):
    rng = random.Random(seed)

    def word(letters, most):
        return "".join(rng.choice(letters) for _ in range(rng.randrange(most)))
    globs = [word(["a", "b", "/", "*", "**", "?", "é"], 9) for _ in range(60)]  # several words of states
    texts = [word("ab/é日", 14) for _ in range(300)]
    automaton = uf.WildcardAutomaton(globs)
    assert automaton.words > 3
    got = automaton.matches(*text_bytes(pa.array(texts)))
    want = np.array([[as_regex(g).fullmatch(t) is not None for g in globs] for t in texts])
    assert (got == want).all()
    few = automaton.matches(*text_bytes(pa.array(texts[:uf.FEW])))  # read one by one
    assert (few == want[:uf.FEW]).all()


def test_wildcard_rules_order_and_default(spark):
    rules = [uf.Rule("block", "*.ads", "/x?/**.gif"), uf.Rule("allow", "b.ads", "/xy/"), uf.Rule("block", "b.ads", "/xz/"),
             uf.Rule("allow", "b.ads", "/xz/")]
    urls = ["http://a.ads/xy/1/2.gif", "http://b.ads/xy/", "http://b.ads/xz/", "http://c/"]
    rows = [(k, u, *"xxxxx") for k, u in enumerate(urls)]
    got = {r["page_id"]: (r["rule"], r["verdict"]) for r in uf.judged(spark.createDataFrame(rows, PAGES), rules, "unknown").collect()}
    assert got == {0: ("*.ads/x?/**.gif", "block"), 1: ("b.ads/xy/", "allow"), 2: ("b.ads/xz/", "block"), 3: (None, "unknown")}
    assert {r["verdict"] for r in uf.judged(spark.createDataFrame(rows, PAGES), []).collect()} == {"allow"}


def test_too_many_states_is_an_error():
    with pytest.raises(ValueError):
        uf.WildcardAutomaton(["a" * 1000] * 300)
