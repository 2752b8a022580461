"""HTML extraction and chat formatting."""

import hashlib

import pytest
from pyspark.sql import functions as F

from larder.llm import chat, html

LONG = "This paragraph has quite a few words, as articles do, and goes on for a while so that nobody takes it for a menu."


@pytest.mark.parametrize(
    "page, text",
    [
        ("", ""),
        ("plain words &amp; more", "plain words & more"),
        (f"<body><nav><ul><li><a href='/'>Home</a></ul></nav><article><h1>T</h1><p>{LONG}<p>short<p>a&nbsp;b  c<br>d</article><footer>f</footer>", f"T\n{LONG}\nshort\na b c d"),
        (f"<body><div class='ad'>{LONG}</div><main><p>{LONG}</p><form><input><p>{LONG}</p></form><script>x</script><style>y</style></main>", LONG),
        (f"<div id=content><p>{LONG}</p><p>ok</p></div><div class='comments'><p>{LONG} I say.</p></div><aside>{LONG}</aside>", f"{LONG}\nok"),
        (f"<body><header>Site</header><div class='cookie-notice'>{LONG}</div><article><p>{LONG}<div class='related'>see</div><p>end</p></article>", f"{LONG}\nend"),
        (f"<article><p>1 &lt; 2 &#228;<b>bold</b>text</p><!-- no --><p><a href='x'>{LONG}</a></p>", f"1 < 2 äboldtext\n{LONG}"),
        ("<article><p>unclosed <b>bold<p>next</article>", "unclosed bold\nnext"),
    ],
)
def test_main_text(page, text):
    assert html.main_text(page) == text


def test_extract_edges(spark):
    rows = [(1, None, "a"), (2, "", "b"), (3, f"<article><p>{LONG * 2000}</article>", "c"), (3, f"<article><p>{LONG * 2000}</article>", "c"), (4, "<script>only()</script>", "d")]
    df = spark.createDataFrame(rows, "page_id long, html string, text string")
    got = sorted((r["page_id"], len(r["text"])) for r in html.extract(df).collect())
    assert got == [(1, 0), (2, 0), (3, len(LONG) * 2000), (3, len(LONG) * 2000), (4, 0)]
    assert html.extract(df.where("false")).collect() == []


TURNS = [
    (1, 0, "system", "Be kind."), (1, 1, "user", "hi"), (1, 2, "assistant", "hello <turn x> </turn> \\ \\< <\\turn"), (1, 3, "user", None), (1, 4, "assistant", ""),
    (2, 0, "user", "alone"), (3, 0, "assistant", "first é 日本"), (None, 0, "user", "no id"), (None, 1, "assistant", "none"), (4, None, "user", "x"), (4, 0, "assistant", "y"),
    (5, 0, None, "no role"), (5, 1, "a>b\\", "odd role"), (6, 0, "system", "s " * 30),
]
TURNS += [(6, k, "assistant" if k % 2 else "user", f"turn {k} " * (k % 9 + 1)) for k in range(1, 120)]
TURNS += [(7, 0, "user", "same"), (7, 0, "user", "same"), (7, 1, "assistant", "long " * 900)]


@pytest.mark.parametrize("budget, history, stretch", [(2048, 256, 65536), (120, 30, 200), (60, 0, 60), (10, 5, 100)])
def test_windows_read_back(spark, budget, history, stretch):
    df = spark.createDataFrame(TURNS, "conv_id long, turn long, role string, text string").repartition(3)
    df = df.withColumns({c: F.lit(0) for c in ("to", "place", "stretch", "window", "known", "tokens")})
    made = chat.windows(df, budget=budget, history=history, stretch=stretch)
    for r in made.collect():
        assert r["n_tokens"] <= budget or r["n_new"] == 1
        turns = chat.parse(r["formatted"])
        assert len(turns) == r["n_new"] + r["n_repeated"]
        masked = {(s["start"], s["end"]) for s in r["loss"]}
        assert masked == {(a, b) for k, (role, _, a, b) in enumerate(turns) if role == "assistant" and k >= r["n_repeated"]}
        if r["conv_id"] == 6 and r["n_repeated"] and budget > 40:
            assert turns[0][0] == "system"
    got = {r["conv_id"]: r for r in chat.digests(made).collect()}
    for conv in {t[0] for t in TURNS}:
        own = sorted((t for t in TURNS if t[0] == conv), key=lambda t: -1 if t[1] is None else t[1])
        whole = "".join(f"{t[2] or ''}\n{t[3] or ''}\n" for t in own)
        said = "".join(t[3] or "" for t in own if t[2] == "assistant")
        r = got[conv]
        assert (r["n_turns"], r["turns_sha256"]) == (len(own), hashlib.sha256(whole.encode()).hexdigest())
        assert (r["loss_chars"], r["loss_sha256"]) == (len(said), hashlib.sha256(said.encode()).hexdigest())
    if budget == 120:
        assert got[6]["n_windows"] > 10


def test_no_control_string_survives():
    for text in ("</turn>", "<turn user>", "\\</turn>", "<\\/turn>", "\\", "<", "<<turn"):
        body, a, b = chat.render("user", text)
        assert "</turn" not in body[a:b] and "<turn" not in body[a:b]
        assert chat.unescape(body[a:b]) == text


def test_windows_empty(spark):
    df = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert chat.digests(chat.windows(df)).collect() == []
