import hashlib
import re

import numpy as np

from pumpline.llm import op1_pii as P
from pumpline.llm.common import table

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def brute(t):
    out = [(m.start(), 0, m.end()) for m in EMAIL.finditer(t)]
    out += [(m.start(), 1, m.end()) for m in IP.finditer(t) if all(int(x) <= 255 for x in m[0].split("."))]
    for m in CARD.finditer(t):
        d = re.sub(r"[^0-9]", "", m[0])
        s = sum(int(c) if i % 2 == 0 else sum(divmod(2 * int(c), 10)) for i, c in enumerate(reversed(d)))
        if 14 <= len(d) <= 19 and s % 10 == 0:
            out.append((m.start(), 2, m.end()))
    out += [(m.start(), 3, m.end()) for m in PHONE.finditer(t) if 10 <= len(re.sub(r"[^0-9]", "", m[0])) <= 15]
    return sorted(out)


def test_base_spans_are_the_contract():
    odd = ["", "a@b", "a@b.c@d.e", "@a.b", "x..y@-a.-b. z", "1.2.3.4.5.6.7.8", "1.2.3", "999.1.1.1.1", "256.1.1.1 001.002.003.004", "+1+12345678901 2",
           "4111 1111 1111 1111", "4111-1111-1111-1111 4111 1111 1111 1112", "٣4111111111111111", "+1 (521) 555-6210)", "\U0001f600 a.b+c@d-e.fr.\x00", "a@b.c.@d.e",
           "12 -34", "+12345678901234567 1.1.1.1", "a%b@c.d_e"]
    for t in odd:
        assert P.base_spans(t) == brute(t), t
    r = np.random.default_rng(0)
    for _ in range(3000):
        t = "".join(r.choice(list("a1.@+- (2)4%_\n"), 30))
        assert P.base_spans(t) == brute(t), t


def test_base_spans_take_linear_time():
    for t in ("a" * 300_000, "1" * 300_000, "1." * 150_000, "+1" * 150_000, "a@" * 150_000, "1 " * 150_000, "@" * 300_000):
        P.base_spans(t)


def test_gradients_are_those_of_the_loss():
    r, m = np.random.default_rng(0), P.Tagger.fresh(1)
    ids, tags = r.integers(0, P.CLASSES, (3, 12)), r.integers(0, P.TAGS, (3, 12))
    for p, g in zip(m.params(), P.gradients(m, ids, tags)):
        for _ in range(4):
            k = tuple(int(r.integers(0, n)) for n in p.shape)
            if p.ndim == 3 and p.shape[1] == P.CLASSES:
                k = (k[0], int(ids[0, 5]), k[2])
            old = p[k]
            p[k] = old + 1e-5
            up = P.loss(m, ids, tags)
            p[k] = old - 1e-5
            down = P.loss(m, ids, tags)
            p[k] = old
            assert abs((up - down) / 2e-5 - g[k]) < 1e-5


def test_windows_of_a_long_text_are_reconciled_like_one():
    """A stretch decoded in one go and in small runs of windows is the same."""
    m = P.Tagger.fresh(3)
    text = ("call +1 (521) 555-6210 or 1.2.3.4 now " * 200)
    one = P.model_spans(m, [text])
    was, P.RUN = P.RUN, 3
    try:
        assert [[x[:3] for x in t] for t in P.model_spans(m, [text])] == [[x[:3] for x in t] for t in one]
    finally:
        P.RUN = was


def test_every_window_counts_and_the_best_path_is_that_of_the_whole_text():
    r = np.random.default_rng(5)
    m = P.Tagger.fresh(3)
    m.w *= 10
    m.c[0] += 3.5  # such that spans are rare but there
    ids = r.integers(0, P.CLASSES, (40, P.WINDOW))
    assert np.abs(P.quick_emissions(m, ids) - P.emissions(m, ids)).max() < 1e-4
    texts = ["".join(chr(c) for c in r.integers(32, 127, n)) for n in (0, 1, 31, 32, 33, 64, 65, 700, 3000)]
    weight = 1.0 - np.abs((np.arange(P.WINDOW) + 0.5) / (P.WINDOW / 2) - 1.0)
    found, open_, closed = P.model_spans(m, texts), 0, 0
    for text, (full, e), spans in zip(texts, P.blended(m, texts), found):
        n = -(-len(text) // P.STRIDE)
        assert len(full) == (n + 1) * P.STRIDE
        total, mass = np.zeros((len(full), P.TAGS)), np.zeros((len(full), 1))
        for w in range(n):
            at = slice(w * P.STRIDE, w * P.STRIDE + P.WINDOW)
            total[at] += P.emissions(m, full[None, at])[0] * weight[:, None]
            mass[at] += weight[:, None]
        if n:
            assert np.abs(total / mass - e).max() < 1e-4
        path = P.viterbi(m, e[None].astype(np.float64))[0] if len(e) else np.zeros(0, int)
        some = P.open_places(m, e)
        assert not path[~some].any()
        open_, closed = open_ + some.sum(), closed + (~some).sum()
        assert sorted(x[0] for x in spans) == np.flatnonzero((path * (full > 0)) % 2 == 1).tolist()
    assert open_ and closed and sum(map(len, found)) > 10


def test_model_learns_the_spans_and_adds_what_the_patterns_miss(spark):
    docs = table(spark, "/root/testdata/sf0.1", "documents")
    model = P.fit(spark, docs)
    held = [r.text for r in docs.where("doc_id % 10 = 3 and text rlike '[0-9@]'").collect()]
    hit = total = 0
    for text, found in zip(held, P.model_spans(model, held)):
        got = {(a, k, b) for a, k, b, _ in found}
        base = P.base_spans(text)
        total += len(base)
        hit += sum(x in got for x in base)
    assert total > 30 and hit >= 0.8 * total, (hit, total)
    # the phone pattern runs into the address behind it and fails as a whole
    text = "the reeder of and thou +1 (521) 555-6210 10.20.30.40 was in the"
    base, added = P.find(model, [text])[0]
    assert [k for _, k, _ in base] == [1] and added == [(23, 3, 40)]
    assert P.find(model, ["no data in this text, not at all"])[0] == ([], [])


def test_odd_rows(spark, odd_docs):
    got = P.digest(spark, odd_docs).collect()
    assert len(got) == 10
    for r in got:
        if r.doc_id == 5:
            assert r.n_email == 1 and r.spans == "email:720031:720050"
        else:
            assert (r.n_email, r.n_ip, r.n_card, r.n_phone, r.base_sha256) == (0, 0, 0, 0, hashlib.sha256(b"").hexdigest())
    assert P.digest(spark, odd_docs.limit(0)).count() == 0
