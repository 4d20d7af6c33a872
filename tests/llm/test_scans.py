"""Personal data and secrets, text by text (no session): kinds that the base
patterns miss, and cover tests on many spans."""

import random

import numpy as np
import pytest


@pytest.fixture(scope="module")
def model():
    from graphloom.llm import pii

    rng = random.Random(2)
    digits = lambda n: "".join(rng.choice("0123456789") for _ in range(n))
    texts = [["call +4 (152) %s-%s now" % (digits(3), digits(4)), "write to u%s@mail.example.com today" % digits(5), "code 2021/%s/11 end" % digits(2),
              "total 1 %s %s units" % (digits(3), digits(3))][i % 4] for i in range(400)]
    ex = [e for t in texts for e in pii.examples(t)]
    return pii.fit_examples([e[0] for e in ex], [e[1] for e in ex])


@pytest.mark.parametrize("text, value", [
    ("my ssn is 123-45-6789 ok", "123-45-6789"), ("mac 00:1a:2b:3c:4d:5e here", "00:1a:2b:3c:4d:5e"),
    ("host fe80:0000:0000:0000:0202:b3ff:fe1e:8329 up", "fe80:0000:0000:0000:0202:b3ff:fe1e:8329"),
    ("seen 4465758382889437 4465758382889437 twice", "4465758382889437"), ("write to bob (at) example (dot) com", "bob (at) example (dot) com"),
    ("IBAN DE89370400440532013000 please", "DE89370400440532013000"), ("call 0123 4567890 now", "0123 4567890")])
def test_learned_kinds(model, text, value):
    from graphloom.llm import pii

    base, found = pii.find_personal(text, model)
    assert (text.index(value), text.index(value) + len(value)) in {(s, e) for k, s, e in found if k == "learned"}
    assert set(base) <= set(found)


@pytest.mark.parametrize("text", ["date 2024-01-02 12:33:44", "on 12.03.2011 - 2012", "at 2024-01-02 12:33:44 phone", "version 1.2.3 is out", "total 1 415 366 units",
                                  "write at 12:30:45", "meet @ noon", "", "clean text"])
def test_clean_texts_stay_clean(model, text):
    from graphloom.llm import pii

    assert pii.find_personal(text, model)[1] == []


def test_cover_equals_plain_comparison():
    from graphloom.llm.pii import Cover
    from graphloom.llm.secret_scan import Within

    rng = random.Random(4)
    for _ in range(200):
        base = [("k", s, s + rng.randint(1, 30)) for s in (rng.randrange(100) for _ in range(rng.randint(0, 12)))]
        cover, within = Cover(base), Within(base)
        for _ in range(30):
            s = rng.randrange(110)
            e = s + rng.randint(1, 25)
            assert ((s, e) in cover) == any(2 * (min(e, b) - max(s, a)) >= e - s for _, a, b in base)
            assert ((s, e) in within) == any(a <= s and e <= b for _, a, b in base)


def test_many_spans_in_one_text_take_linear_time(model):
    from graphloom.llm import pii, secret_scan

    text = "u@mail.example.com 123-45-6789 " * 20_000
    assert len(pii.find_personal(text, model)[0]) == 20_000
    text = "password=abcdef123 login: changeme " * 20_000
    assert sum(k == "assign" for k, _, _ in secret_scan.find_secrets(text, {"changeme": 3})[1]) == 20_000


@pytest.mark.parametrize("text, value", [
    ("kennwort: Zk39dkQw01x!", "Zk39dkQw01x"), ("Authorization: Bearer aZ39dkQw01xQQ77", "aZ39dkQw01xQQ77"), ("https://user:Zk39dkQw01@host/x", "Zk39dkQw01"),
    ("pass word: Zk39dkQw01", "Zk39dkQw01"), ("mot de passe : Zk39dkQw01", "Zk39dkQw01"), ("contraseña: Zk39dkQw01", "Zk39dkQw01"),
    ("Passwort ist Zk39dkQw01", "Zk39dkQw01"), ("user_pwd=Zk39dkQw01", "Zk39dkQw01")])
def test_secrets_in_four_languages_and_headers(text, value):
    from graphloom.llm.secret_scan import find_secrets

    at = text.index(value)
    assert ("guess", at, at + len(value)) in find_secrets(text, {})[1]


@pytest.mark.parametrize("text", ["login is hello", "clave: perro", "see http://example.com:8080/a@b", "Kennwort: hallo", "bearer of news", "mapping = value"])
def test_words_are_no_secrets(text):
    from graphloom.llm.secret_scan import find_secrets

    assert find_secrets(text, {w: i + 1 for i, w in enumerate("hello perro hallo value news".split())})[1] == []


def test_sieved_words_and_pairs_are_counted_by_piece():
    from graphloom.llm.collocations import _Checksums, _words

    words, h, pair = _words(b"A b. b a\tb;;c", _Checksums(), 7)
    assert words == [b"a", b"b", b".", b"b", b"a", b"b", b".", b".", b"c"]
    assert [bool(x) for x in h] == [w != b"." for w in words] and h[0] == h[4] and h[1] == h[3] == h[5]
    assert np.flatnonzero(pair).tolist() == [1, 4, 5] and pair[1] == pair[5] != pair[4]
