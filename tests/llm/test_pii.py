import hashlib
import random
import re

from ledgerspark.llm.pii import KINDS, base_spans, candidates, luhn, patterns, personal_data, redact, shape
from ledgerspark.llm.queries import QUERIES

PLAIN = {
    "email": r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+",
    "ip": r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)",
    "card": r"[0-9]([\x20-]?[0-9])+",
    "phone": r"\+[0-9][\x20().0-9-]+[0-9]",
}


def plain(text):
    """The base definition as it is written."""
    out = []
    for k, kind in enumerate(KINDS):
        for m in re.finditer(PLAIN[kind], text):
            digits = re.sub("[^0-9]", "", m[0])
            if (
                kind == "email"
                or kind == "ip"
                and all(int(p) <= 255 for p in m[0].split("."))
                or kind == "card"
                and 14 <= len(digits) <= 19
                and luhn(digits)
                or kind == "phone"
                and 10 <= len(digits) <= 15
            ):
                out.append((m.start(), k, m.end()))
    return sorted(out)


def listed(spans):
    return ",".join(f"{KINDS[k]}:{a}:{b}" for a, k, b in spans)


def test_base_spans_equal_the_plain_expressions():
    rng = random.Random(3)
    for _ in range(20_000):
        text = "".join(rng.choice("ab._%+-@@..1234567890  ()+é\n") for _ in range(rng.randint(0, 60)))
        assert base_spans(text) == plain(text), text


def test_luhn():
    assert luhn("4111111111111111") and not luhn("4111111111111112")


def test_query_against_plain(spark, small):
    got = {r.doc_id: r for r in QUERIES["op9_personal_data"](spark, "/root/testdata/sf0.001").collect()}
    assert len(got) == len(small)
    for i, text in zip(small.doc_id, small.text, strict=True):
        spans, r = plain(text or ""), got[i]
        assert r.base_sha256 == hashlib.sha256(listed(spans).encode()).hexdigest()
        assert [r.n_email, r.n_ip, r.n_card, r.n_phone] == [sum(k == n for _, k, _ in spans) for n in range(4)]
        assert set(listed(spans).split(",")) <= set(r.spans.split(","))


def test_contexts_find_unseen_identifiers(spark):
    seen = [(i, f"Your member line is +1 (415) 555-0{100 + i} today said {i}x") for i in range(8)]
    new = [(20 + i, f"well my member line is X-99{i}-AB today maybe") for i in range(4)]
    other = [(40 + i, f"item number{i} costs {i}00eur each") for i in range(9)]
    docs = spark.createDataFrame(seen + new + other, "doc_id long, text string")
    got = {r.doc_id: r.spans_list for r in personal_data(docs).collect()}
    for i, t in new:
        at = t.index("X-99")
        assert got[i] == f"phone:{at}:{at + 8}"
    assert all(got[i] == "" for i, _ in other)
    clean = {r.doc_id: r.text for r in redact(docs).collect()}
    assert clean[20] == "well my member line is [PHONE] today maybe"
    assert clean[40] == other[0][1] and "555" not in clean[3]


def test_odd_rows(odd_docs, no_docs):
    rows = personal_data(odd_docs).collect()
    assert len(rows) == odd_docs.count()
    assert {r.doc_id: r.spans_list for r in rows if r.doc_id in (1, 2, 3)} == {1: "", 2: "", 3: ""}
    ten = next(r for r in rows if r.doc_id == 10)
    assert (ten.n_email, ten.n_ip, ten.n_card, ten.n_phone) == (1, 1, 1, 1)
    clean = redact(odd_docs)
    assert clean.columns == odd_docs.columns and clean.count() == odd_docs.count()
    by = {r.doc_id: r for r in clean.collect()}
    assert by[10].text == "mail me: [EMAIL] or [PHONE], ip [IP], card [CARD]."
    assert by[10].n_chars == len(by[10].text) and by[1].text is None and by[1].n_chars is None
    assert personal_data(no_docs).count() == 0 and redact(no_docs).count() == 0


def test_a_chain_of_five_steps(spark):
    """Each step's identifiers share a context with those of the step before
    only; the iteration goes on until the last is found."""
    words = ["amber", "birch", "cedar", "dune", "ember", "fjord", "grove"]
    sizes = [96, 48, 24, 12, 6, 3]  # of step 0 all are phones
    ids = [[f"+1 (415) 555-{k:04d}" if not step else f"Q{step}{k:03d}-{k % 7}" for k in range(n)] for step, n in enumerate(sizes)]
    texts = []
    for step, own in enumerate(ids):
        for i in own:
            texts.append(f"the {words[step]} number {i} here")
            if step:
                texts.append(f"the {words[step - 1]} number {i} here")
    texts += [f"some other {words[6]} code Z{k:03d}-1 there" for k in range(20)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: r.spans_list for r in personal_data(df).collect()}
    for k, t in enumerate(texts):
        assert (got[k] == "") == ("code Z" in t), t
        assert got[k] == "" or got[k].startswith("phone:")


def test_patterns_and_candidates():
    text = 'token = "AB12-x", call 0171 555 0123. Mail a@b or (030) 12-34; v2'
    assert [text[a:b] for a, b in candidates(text, [])] == ["AB12-x", "0171 555 0123", "a@b", "(030) 12-34", "v2"]
    a = text.index("AB12")
    assert patterns(text, a, a + 6) == ['token=" _ a9-a', "token _ call", '_ a9-a ",call']
    assert shape("Äb12-x") == "a9-a"
    long = "x" * 200_000 + " " * 100_000 + "AB12"
    assert len(patterns(long, 300_000, 300_004)[0]) > 200_000  # no reach that ends
    assert len(candidates("(" * 100_000 + "1", [])) == 1
