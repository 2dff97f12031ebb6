import re
from collections import defaultdict

from macrospark.llm import url_filter
from macrospark.llm.common import table

SF = "/root/testdata/sf0.01"


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match("[^/?#]*", rest)[0]
    path = re.match("[^?#]*", rest[len(host) :])[0]
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in host), path


def rule(host, path):
    best = None
    for say, r in url_filter.RULES:
        h, _, p = r.partition("/")
        if (host == h or host.endswith("." + h)) and path.startswith("/" + p) and (best is None or len(r) > len(best[1])):
            best = say, r
    return best


def brute(pages):
    """Verdicts of (url, bad) rows, by the documented tree, in plain Python."""
    u = url_filter
    rows = []
    for url, bad in pages:
        host, path = parts(url)
        shape = tuple(
            "{x}" if re.fullmatch("[0-9a-fA-F-]{8,}", s) and re.search("[a-fA-F]", s) else re.sub("[0-9]+", "{n}", s)
            for s in path.split("/") if s
        )
        rows.append((host, path, shape, bad))
    template = {(h, s): "" for h, _, s, _ in rows}
    for level in range(max(len(s) for _, s in template)):
        child, parent = defaultdict(lambda: [0, 0, 0]), defaultdict(lambda: [set(), 0, 0, 0])
        segment = {k: k[1][level] for k in template if len(k[1]) > level}
        for h, _, s, bad in rows:
            if (h, s) in segment:
                t, g = template[h, s], segment[h, s]
                add = (1, bad is not None, bad or 0)
                for i, x in enumerate(add):
                    child[h, t, g][i] += x
                    parent[h, t][i + 1] += x
                parent[h, t][0].add(g)
        for k, g in segment.items():
            node = k[0], template[k]
            n, labels, bad = child[*node, g]
            kinds, all_n, all_labels, all_bad = parent[node]
            rate = all_bad / max(all_labels, 1)
            error = u.Z * (labels * rate * (1 - rate)) ** 0.5
            spread = all_n**2 / sum(child[*node, x][0] ** 2 for x in kinds)
            if len(kinds) == 1:
                name = g
            elif labels and labels * max(rate, 1 - rate) > error:
                name = "~" if abs(bad - labels * rate) <= error else g
            else:
                name = "*" if spread >= u.SPREAD else g
            segment[k] = f"{template[k]}/{name}"
        template.update(segment)
    by_host, by_template, everything = defaultdict(lambda: [0, 0]), defaultdict(lambda: [0, 0]), [0, 0]
    for h, _, s, bad in rows:
        if bad is not None:
            for x in (by_host[h], by_template[h, template[h, s]], everything):
                x[0] += 1
                x[1] += bad
    out = []
    for h, path, s, _ in rows:
        base = everything[1] / max(everything[0], 1)
        prior = (by_host[h][1] + u.A * base) / (by_host[h][0] + u.A)
        labels, bad = by_template[h, template[h, s]]
        fixed = rule(h, path)
        verdict = fixed[0] if fixed else "block" if (bad + u.A * prior) / (labels + u.A) >= u.REJECT else "allow"
        out.append((h, path, fixed[1] if fixed else None, verdict, template[h, s]))
    return out


def compare(frame, pages):
    got = frame.collect()
    return sorted(map(repr, [tuple(r)[1:] for r in got])) == sorted(map(repr, brute(pages)))


def test_the_given_pages(spark):
    rows = url_filter.labelled(table(spark, SF, "pages"), table(spark, SF, "labels"))
    pages = [(r["url"], r["bad"]) for r in rows.collect()]
    assert sum(bad is not None for _, bad in pages) > 50
    assert compare(url_filter.judge(rows, bad="bad", keep=["page_id"]), pages)


def test_trees_with_wildcards_merges_and_rejections(spark):
    pages = []
    for i in range(60):
        pages.append((f"https://A.org/shop/item-{i}x{'abcdefgh'[i % 8]}{i}/buy", 1 if i % 4 else 0))
        pages.append((f"http://b.org/{'spam' if i % 2 else 'news'}/{'qwertyuiopasdfghjklzxcvbnm'[i % 26] * (i // 26 + 1)}?q={i}", i % 2))
        pages.append((f"http://sub.b.org/fr/{i}#x", None))
        pages.append((f"http://sub.b.org/u/{'qwertyuiopas'[i % 12] * 2}/me", None))
        pages.append(("http://c.com/" + "/".join("ab"[i % 2] for _ in range(11)), 0))
    pages += [(None, 1), ("no scheme", 0), ("http://", 1), ("x://h?q", None), ("http://example.com/de", 1), ("http://EXAMPLE.com/de/", 0),
              ("http://net/", None), ("http://a.net?x=/", None), ("http://h.org/0123456789abcdef/x", 1)] * 2
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, bad int")
    judged = url_filter.judge(frame, bad="bad", keep=["page_id"])
    assert compare(judged, pages)
    assert {r["verdict"] for r in judged.where("rule is null").collect()} == {"allow", "block"}
    assert judged.where("template like '%/*%'").count() and judged.where("template like '%~%'").count()


def test_a_planted_bad_template_is_blocked_at_every_size(spark):
    for size in (1, 10):
        pages = []
        for i in range(240 * size):
            label = int(i % 20 == 0) if i % 2 == 0 else None
            pages.append((f"https://a.com/{'en' if i % 3 else 'de'}/read/{i}", label))
            if i % 4 < 2:
                pages.append((f"https://a.com/{'en' if i % 3 else 'de'}/pills/{i}", None if label is None else 1 - label))
            pages.append((f"https://a.com/u/{'abcdefghijkl'[i % 12] * 3}", None))
        frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, bad int")
        judged = url_filter.judge(frame, bad="bad", keep=["page_id"])
        assert compare(judged, pages)
        assert {r["path"].split("/")[2] for r in judged.where("verdict = 'block'").collect()} == {"pills"}
        assert judged.where("verdict = 'block'").count() == 120 * size
        assert judged.where("template = '/u/*'").count() == 240 * size


def test_templates_part_at_any_depth(spark):
    deep = "/".join("abcdefghijklmnopqrst")
    pages = [(f"http://d.com/{deep}/{'good' if i % 2 else 'bad'}/{i}", 1 - i % 2) for i in range(40)]
    pages += [(f"http://d.com/{deep}", None), ("http://d.com/" + "x/" * 3000, 0)]
    frame = spark.createDataFrame([(i, *p) for i, p in enumerate(pages)], "page_id long, url string, bad int")
    judged = url_filter.judge(frame, bad="bad", keep=["page_id"])
    assert compare(judged, pages)
    assert judged.where("verdict = 'block'").count() == 20 == judged.where("verdict = 'block' and path like '%/bad/%'").count()


def test_odd_columns_and_empty_tables(spark, labels):
    schema = "page_id long, url string, host string, kept int, template string"
    frame = spark.createDataFrame([(1, "http://a.net/", "x", 1, None), (1, "http://a.net/", "x", 1, None), (None, None, None, None, "t")], schema)
    got = url_filter.digest_columns(frame, labels).collect()
    assert [(r["host"], r["verdict"]) for r in sorted(got, key=lambda r: r["host"])] == [("", "allow"), ("a.net", "block"), ("a.net", "block")]
    assert url_filter.digest_columns(frame.limit(0), labels).count() == 0
