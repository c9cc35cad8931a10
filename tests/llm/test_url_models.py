"""The URL filter's models against plain counting, with more n-grams than any table of fixed size would tell apart."""

from __future__ import annotations

import math
import random
from collections import Counter

from ebbtide.llm import url_filter


def differences(urls, accepted, rejected):
    """Log-likelihood by ``accepted`` less that by ``rejected``, over the number of characters."""

    def windows(url):
        data = b"\x02" + url.encode() + b"\x03"
        return [[(data[max(0, i - k) : i], data[i]) for k in range(url_filter.ORDERS)] for i in range(1, len(data))]

    def model(of):
        joint, seen = Counter(), Counter()
        for url in of:
            for orders in windows(url):
                joint.update((k, *w) for k, w in enumerate(orders))
                seen.update((k, w[0]) for k, w in enumerate(orders))
        return joint, seen

    models = [model(accepted), model(rejected)]
    for url in urls:
        total = []
        for joint, seen in models:
            logs = []
            for orders in windows(url):
                p = 1 / 256
                for k, w in enumerate(orders):
                    p = (joint[k, *w] + url_filter.STRENGTH * p) / (seen[k, w[0]] + url_filter.STRENGTH)
                logs.append(math.log(p))
            total.append(sum(logs) / len(logs))
        yield total[0] - total[1]


def test_scores_equal_plain_counting_of_many_ngrams(spark):
    draw = random.Random(2)
    signs = "abcdefghijklmnopqrstuvwxyz0123456789"
    urls = [f"http://{h}/{p}/" + "".join(draw.choices(signs, k=40)) for _ in range(700) for h, p in (("a.org", "x"), ("b.com", "de"), ("c.net", "x"))]
    urls += ["", "é\x00\x02"]
    assert len({u[i : i + 5] for u in urls for i in range(len(u))}) > 60_000
    rows = url_filter.judge(spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").repartition(3)).collect()
    assert len(rows) == len(urls)
    rows = {r["page_id"]: r for r in rows}
    ruled = {v: [urls[i] for i, r in rows.items() if r["rule"] and r["verdict"] == v] for v in ("allow", "block")}
    got = [rows[i]["score"] for i in range(len(urls))]
    want = list(differences(urls, ruled["allow"], ruled["block"]))
    threshold = want[0] - got[0]
    assert max(abs(w - g - threshold) for w, g in zip(want, got)) < 1e-9
