import random

from pyspark.sql import functions as F

from keelson.llm import chat, url_rules
from keelson.llm.url_rules import Rule, host_rule


def test_chats_read_back(spark):
    rng = random.Random(3)
    bits = ["<|im_end|>", "<|im_start|>", "<|im_next|>", "\n", "%", "%25", "%0A", "<%7C", "<", "|", "ok", "é", "", "\\", "$1"]
    some = lambda n: "".join(rng.choice(bits) for _ in range(rng.randint(0, n)))
    rows = []
    for conv in range(40):
        for turn in range(rng.randint(1, 9)):
            role = rng.choice(["user", "assistant", "assistant", "system", None, "a\nb%0A<|", "assistant "])
            rows.append((conv, rng.choice([turn, turn, 3, None]), role, rng.choice([None, some(8), some(8)])))
    rows += [(None, 1, "user", "x"), (None, 1, "user", "x"), (99, 5, "assistant", "y" * 100000)]
    frame = spark.createDataFrame([(*r, "c") for r in rows], "conv_id long, turn long, role string, text string, formatted string")
    made = chat.format_chats(frame.repartition(3)).select(
        "conv_id", "formatted", chat.read_turns(F.col("formatted")).alias("turns"), chat.loss_text(F.col("segments")).alias("loss")
    )
    got = {r.conv_id: r for r in made.collect()}
    want = {}
    for conv, turn, role, text in rows:
        want.setdefault(conv, []).append(((turn is not None, turn or 0), role or "", text or ""))
    assert got.keys() == want.keys()
    for conv, turns in want.items():
        turns.sort(key=lambda t: (t[0], t[1].encode(), t[2].encode()))
        assert [(t.role, t.text) for t in got[conv].turns] == [(r, t) for _, r, t in turns], conv
        assert got[conv].loss == "".join(t for _, r, t in turns if r == "assistant")
        messages = 1 + sum(a[1] != b[1] for a, b in zip(turns, turns[1:], strict=False))
        assert got[conv].formatted.count("<|im_start|>") == got[conv].formatted.count("<|im_end|>") == messages
        assert got[conv].formatted.count("<|") == 2 * messages + (len(turns) - messages)
    assert chat.format_chats(frame.limit(0)).count() == 0


def slow_verdict(url, rules):
    if url is None or "://" not in url:
        return "", "", None, None, "allow"
    import re

    after = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", after)[0]
    rest = after[len(host) :]
    path = re.match(r"[^?#]*", rest)[0]
    host = "".join(c.lower() if "A" <= c <= "Z" else c for c in host)
    fits = []
    for r in rules:
        if r.rank == 0:
            rule_host, _, rule_path = r.name.partition("/")
            if (host == rule_host or host.endswith("." + rule_host)) and path.startswith("/" + rule_path):
                fits.append(r)
        elif re.search(r.pattern.replace(r"\z", r"\Z"), host + rest):
            fits.append(r)
    best = min(fits, key=lambda r: (r.rank, -len(r.name), r.name), default=None)
    name = best.name if best else None
    return host, path, name if best and best.rank == 0 else None, name, best.action if best else "allow"


def test_urls(spark):
    rng = random.Random(4)
    hosts = ["net", "example.net", "EXAMPLE.net", "notexample.net", "a.example.com", "org", "x.org", "casino.example.org",
             "myexample.com", "porn-site.com", "net.com", "", "a.net:80", "u@b.net"]
    paths = ["", "/", "/en/", "/en", "/EN/x", "/de/1", "/fr/2?x=.net/", "?u=.net/", "#/en/", "/login", "/a/login.php?q",
             "/cart/", "/x.exe", "/x.exe?y", "/wp-admin/a", "/a/://b", "/en/\nx", "/casino/"]
    urls = [f"{rng.choice(['http', 'https', 'ftp', ''])}://{h}{p}" for h in hosts for p in paths]
    urls += [None, "", "example.net/en/", "http:/x.net/", "mailto:a@net/", "http://x.net/" + "a/" * 20000]
    rules = url_rules.HOST_RULES + url_rules.GENERAL_RULES
    rows = [(i, u, "c") for i, u in enumerate(urls)] + [(0, urls[0], "d"), (None, "http://b.net/", "e")]
    frame = spark.createDataFrame(rows, "page_id long, url string, verdict string").repartition(3)
    got = [tuple(r) for r in url_rules.judge(frame).collect()]
    want = [(i, *slow_verdict(u, rules)) for i, u, _ in rows]
    assert sorted(map(repr, got)) == sorted(map(repr, want))
    assert url_rules.judge(frame.limit(0)).count() == 0


def test_rarest_token_indexes(spark):
    rules = spark.createDataFrame([("r", "block", 0, "x", ["com", "rare", "common"])], "name string, action string, rank int, pattern string, tokens array<string>")
    seen = spark.createDataFrame([("com",)] * 5 + [("common",)] * 3 + [("rare",)], "token string")
    assert [r.token for r in url_rules.index(rules, seen).collect()] == ["rare"]
    assert [r.token for r in url_rules.index(rules, seen.filter("token = 'com'")).collect()] == ["common"]


def test_rules_are_checked():
    for bad in [("a", "block", "x", ()), ("a", "deny", "x", ("a",)), ("a", "allow", "x", ("A-b",))]:
        try:
            Rule(*bad)
        except ValueError:
            continue
        raise AssertionError(bad)
    assert host_rule("a.b/", "allow").tokens == ("a", "b")
