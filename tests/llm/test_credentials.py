import hashlib
import re

from citegrid.llm import credentials as cr

KEY = "AKIA" + "ABCDEFGH12345678"
TOKEN = "Zx9aQw8eRt7yUi6oPa5s"
CASES = [
    "", "nothing here", f"password = {'a' * 12}", f"password = {'a' * 11}", "Token:'abcdefghijkl' ;", "apikey=\"abcdef123456\"",
    f"token: secret: {'b' * 12}", f"token=password={'c' * 12}", f"x{KEY}y", "AKIA" + "A" * 13, "0123456789abcdef", "0123456789abcde",
    "AKIAAKIA" + "1" * 12, f"API_KEY : {KEY} deadbeefdeadbeef", "päss secret=" + "é" * 20, "ſecret=abcdefghijklm", "toKen=abcdefghijklm",
    f"{KEY}\n{TOKEN}", f"{TOKEN} alone", f"{KEY}\n\n{TOKEN}", f"{KEY} {'x ' * 200}{TOKEN}", f"see https://db.example/x {KEY}",
    "see https://db.example/x alone", "user: alice password: hunter2hunter2", "日本 password=abcdefabcdef123456 日本",
]


def base_plain(text):
    """The contract's rules, position by position."""
    out, at = [], 0
    p = re.compile(r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.ASCII)
    while m := p.search(text, at):
        if len(m.group(2)) >= 12:
            out.append((m.start(), 0, "assign", m.end()))
        at = m.end()
    for kind, pattern, least, rank in (("access", r"AKIA[A-Z0-9]+", 18, 1), ("hex", r"[0-9a-f]+", 16, 2)):
        out += [(m.start(), rank, kind, m.end()) for m in re.finditer(pattern, text) if len(m.group()) >= least]
    return [(s, e, k) for s, _, k, e in sorted(out)]


def test_base_spans():
    for text in CASES:
        assert cr.base_spans(text) == base_plain(text), text


def mixed(t):
    return all(re.search(p, t) for p in ("[0-9]", "[a-z]", "[A-Z]")) and len(set(t)) >= 10


def linked_plain(text, reach=200):
    """The rule on every pair of parts, by positions; none of the operator's code."""
    base = base_plain(text)
    urls = [m.span() for m in re.finditer(r"(?:https?|wss?|jdbc:[a-z]+|postgres(?:ql)?|mysql|mongodb(?:\+srv)?|redis|amqps?)://[^\s\"'<>]+", text)]
    ids = [m.span(1) for m in re.finditer(r"""(?i:\b(?:user(?:name)?|account|client_?id|access_?key_?id|login))["']?\x20*[:=]\x20*["']?([A-Za-z0-9._@-]{3,})""",
                                          text, re.ASCII)]
    places = []
    for s, e in urls:
        url = text[s:e]
        for p in (r"://([^/?#@]+)@", r"[?&;#](?i:[a-z_-]*(?:key|token|secret|passwd|password|signature|sig|auth|credential))=([^&;#]+)"):
            places += [(s + m.start(1), s + m.end(1), (s, e)) for m in re.finditer(p, url, re.ASCII)]
    outside = "".join("\0" if any(s <= i < e for s, e in urls) else c for i, c in enumerate(text))
    tokens = {m.span(): None for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", outside) if mixed(m.group())}
    for s, e, url in places:
        tokens.update({(s + m.start(), s + m.end()): url for m in re.finditer(r"[A-Za-z0-9+/_=-]{20,}", text[s:e]) if mixed(m.group())})
    own = {i for s, e, k in base if k != "hex" for i in range(s, e)}
    taken = {i for s, e, _ in base for i in range(s, e)}
    left = lambda s, e: not taken.issuperset(range(s, e))
    tokens = {t: u for t, u in tokens.items() if left(*t) and mixed("".join(text[i] for i in range(*t) if i not in own))}
    urls_left, ids = [u for u in urls if left(*u)], {i for i in ids if left(*i)}
    kinds = {k: [(s, e) for s, e, b in base if b == k] for k in ("assign", "access", "hex")}
    kinds["hex"] = [(s, e) for s, e in kinds["hex"] if not any(a <= s and e <= b for a, b in urls)
                    or any(a <= s and e <= b for a, b, _ in places)]
    kinds |= {"token": list(tokens), "identifier": list(ids), "endpoint": urls_left}

    def near(s, e, *which):
        for k in which:
            for s2, e2 in kinds[k]:
                between = text[e:s2] if s2 >= e else text[e2:s] if e2 <= s else None
                if between is not None and len(between) <= reach and "\n\n" not in between:
                    return True
        return False
    out = [(s, e, "linked_token") for (s, e), url in tokens.items() if url or near(s, e, "access", "identifier", "endpoint")]
    out += [(s, e, "linked_identifier") for s, e in ids if near(s, e, "assign", "token", "hex")]
    out += [(s, e, "linked_endpoint") for s, e in urls_left if (s, e) in tokens.values() or near(s, e, "access", "assign", "token")
            or near(s, e, "hex") and near(s, e, "identifier")]
    return sorted(out)


PIECES = [KEY, TOKEN, "0123456789abcdef0123", "https://db.example/x", f"https://db.example/d/{TOKEN}", f"https://db.example/?a=1&key={TOKEN}x",
          f"postgres://bob:{TOKEN}@db.example/x", "https://x.example/0123456789abcdef01", "user: alice", "account=bob", "password: hunter2hunter2",
          "\n\n", "\n", "word", "x " * 99, f"x{KEY}y", f"secret={TOKEN}", f"{TOKEN}/https://db.example/y", "wss://h/?token=abcdefabcdefabcd"]


def test_random_texts_equal_the_plain_rule():
    import random
    rng = random.Random(5)
    linked = 0
    for _ in range(400):
        text = "".join(rng.choice(PIECES) + rng.choice([" ", " ", "\n", ""]) for _ in range(rng.randint(1, 9)))
        got = cr.linked_spans(text, cr.base_spans(text))
        assert got == linked_plain(text), text
        linked += len(got)
    assert linked > 300


def test_ordinary_prose_stays():
    for text in ["See https://example.org/about and https://drive.example.org/d/1AbCdEfGh2iJkLmNoP3q for slides.",
                 "account: premium, see https://example.org/help",
                 "Login: required. Manual at https://example.org/manual/Chapter12OfTheGuide, https://example.org/b",
                 "user: alice at https://db.example.com/v1"]:
        assert cr.redact_text(text) == text
    # a hex run is a base finding, the link beside it is none
    assert cr.redact_text("commit 0123456789abcdef0123 fixed, docs at https://docs.example.org/page") == \
        "commit [hex] fixed, docs at https://docs.example.org/page"


def test_long_tokens_are_linear():
    import time

    def seconds(n):
        text = TOKEN * 6000 + " " + "https://h.example/x " * n
        t = time.perf_counter()
        assert len(cr.find(text)[1]) == 11                  # the token, and the links within reach of it
        return time.perf_counter() - t
    seconds(1000)
    assert seconds(16_000) < 2.0


def test_links_only_complementary_parts():
    for text in CASES + ["\n".join(CASES), f"{KEY} " * 300 + f"{TOKEN} " * 300]:
        assert cr.linked_spans(text, cr.base_spans(text)) == linked_plain(text), text
    kinds = lambda t: [k for _, _, k in cr.find(t)[1]]
    assert kinds(f"{KEY}\n{TOKEN}") == ["linked_token"] and kinds(f"{TOKEN} alone") == [] and kinds(f"{KEY}\n\n{TOKEN}") == []
    assert kinds(f"see https://db.example/x {KEY}") == ["linked_endpoint"] and kinds("see https://db.example/x alone") == []


def test_links_go_both_ways():
    key, url, run = "wJalrXUtnFEMIK7MDENGbPxRfiCY9z", "https://db.example.com/v1", "ghp_AbCdE0123456789abcdef01ZqXw9"
    cases = [                                            # text, findings, text without them; written by hand
        (f"endpoint {url}\nkey {key}", "linked_endpoint:9:34,linked_token:39:69", "endpoint [linked_endpoint]\nkey [linked_token]"),
        (f"key {key}\nendpoint {url}", "linked_token:4:34,linked_endpoint:44:69", "key [linked_token]\nendpoint [linked_endpoint]"),
        (f"endpoint {url}\n\nkey {key}", "", f"endpoint {url}\n\nkey {key}"),
        (f"endpoint {url}\n{'x ' * 101}{key}", "", f"endpoint {url}\n{'x ' * 101}{key}"),
        (f"user: alice key {key}", "linked_identifier:6:11,linked_token:16:46", "user: [linked_identifier] key [linked_token]"),
        (f"user: bob 0123456789abcdef {url}", "linked_identifier:6:9,hex:10:26,linked_endpoint:27:52", "user: [linked_identifier] [hex] [linked_endpoint]"),
        (f"at mysql://bob:{key}@h.example/x", "linked_endpoint:3:57,linked_token:15:45", "at [linked_endpoint]"),
        (f"{KEY} {run} end", "access:0:20,linked_token:21:53,hex:30:48", "[access] [linked_token] end"),
        (f"{run} alone", "hex:9:27", "ghp_AbCdE[hex]ZqXw9 alone"),
        (f"{KEY} at {url}/0123456789abcdef01/x", "access:0:20,linked_endpoint:24:70,hex:50:68", "[access] at [linked_endpoint]"),
        (f"{KEY}\nDB_PASSWORD={TOKEN} end", "access:0:20,assign:24:53", "[access]\nDB_[assign] end"),
        (f"{KEY}\nx{KEY}y", "access:0:20,access:22:42", "[access]\nx[access]y"),
    ]
    for text, spans, redacted in cases:
        base, linked = cr.find(text)
        assert cr._join(sorted(base + linked, key=cr._order)) == spans and cr.redact_text(text) == redacted, text


def test_scan(spark, docs, rows):
    df = spark.createDataFrame([(i, t, "x") for i, t in enumerate(CASES)] + [(None, None, "x"), (0, CASES[2], "x")],
                               "doc_id long, text string, spans string")
    got = cr.scan(df).collect()
    assert len(got) == len(CASES) + 2
    by = {r.doc_id: r for r in got if r.doc_id not in (None, 0)}
    for i, t in enumerate(CASES):
        if i:
            spans = base_plain(t)
            joined = ",".join(f"{k}:{s}:{e}" for s, e, k in spans)
            assert by[i].base_sha256 == hashlib.sha256(joined.encode()).hexdigest()
            assert (by[i].n_assign, by[i].n_access, by[i].n_hex) == tuple(sum(k == x for _, _, k in spans) for x in cr.BASE)
            assert set(joined.split(",")) - {""} <= set(by[i].spans.split(","))
    null = [r for r in got if r.doc_id is None][0]
    assert null.spans == "" and null.base_sha256 == hashlib.sha256(b"").hexdigest()
    assert cr.scan(docs).count() == len(rows)


def test_redact(spark, docs, empty):
    assert cr.redact_text("user: alice password: hunter2hunter2 end") == "user: [linked_identifier] [assign] end"
    assert cr.redact_text("password = 0123456789abcdef!") == "[assign]!" and cr.redact_text(None) is None
    df = spark.createDataFrame([(1, f"a {KEY} b", 24), (2, "clean", 5), (3, None, None)], "doc_id long, text string, n_chars long")
    assert [tuple(r) for r in cr.redact(df).orderBy("doc_id").collect()] == [(1, "a [access] b", 12), (2, "clean", 5), (3, None, None)]
    assert cr.redact(docs).columns == docs.columns and cr.redact(docs).count() == docs.count()
    assert cr.redact(empty).count() == 0
