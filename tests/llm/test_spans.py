"""Personal data and secrets: base spans against plain patterns, added spans by example."""

import hashlib
import random
import re
import time

import pytest
from llm_cases import docs  # noqa: F401

from quizframe.llm.pii import AGAINST, CONTEXT, find_personal, luhn, mod97, personal_digests
from quizframe.llm.secrets import find_secrets, secret_digests, sensitivity

PII, SECRETS = ["email", "ip", "card", "phone"], ["assign", "access", "hex"]


def plain_luhn(digits):
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def plain_personal(t):
    out = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", t)]
    for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", t):
        if all(int(x) <= 255 for x in m[0].split(".")):
            out.append(("ip", *m.span()))
    for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", t):
        d = re.sub("[^0-9]", "", m[0])
        if 14 <= len(d) <= 19 and plain_luhn(d):
            out.append(("card", *m.span()))
    for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", t):
        if 10 <= len(re.sub("[^0-9]", "", m[0])) <= 15:
            out.append(("phone", *m.span()))
    return sorted(out, key=lambda x: (x[1], PII.index(x[0])))


def plain_secrets(t):
    keys = "[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
    out = [("assign", *m.span()) for m in re.finditer(rf"({keys})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)", t) if len(m[2]) >= 12]
    out += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    out += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
    return sorted(out, key=lambda x: (x[1], SECRETS.index(x[0])))


def base(found, kinds):
    return sorted(((k, a, b) for k, a, b, _ in found if k in kinds), key=lambda x: (x[1], kinds.index(x[0])))


def test_random_texts():
    rng = random.Random(1)
    personal = ["@", ".", "1", "23", "4111 1111 1111 1111", "a", "-b", "+1", "(", ")", " ", "255.", "0.", "300", "%", "é", "@x.y"]
    secret = ["password", "Token", "api_key", "apikey", "=", " ", ":", "'", '"', "abcdef123456", "deadbeef", "AKIA", "ABCDEF12345678", "x", "\n"]
    for _ in range(20000):
        t = "".join(rng.choices(personal, k=rng.randint(1, 14)))
        assert base(find_personal(t), PII) == plain_personal(t)
        t = "".join(rng.choices(secret, k=rng.randint(1, 9)))
        assert base(find_secrets(t), SECRETS) == plain_secrets(t)


def plain_added(t):
    """Further kinds by trying every span, with a score from the words around it."""
    out = []
    word = lambda c: c.isalnum()
    end = 0
    for i in range(len(t)):
        if i < end or (i and t[i - 1].isascii() and t[i - 1].isalnum()):
            continue
        for j in range(min(len(t), i + 4 + 60), i, -1):
            compact = t[i:j].replace(" ", "")
            shape = re.fullmatch(r"[A-Z]{2}[0-9]{2}(\x20?[A-Z0-9]){11,30}", t[i:j])
            if shape and not word(t[j : j + 1] or " ") and int("".join(str(int(c, 36)) for c in compact[4:] + compact[:4])) % 97 == 1:
                out.append(("iban", i, j))
                end = j
                break
    for kind, pattern, before, after in (("local_phone", r"\(?[0-9]{3}\)?[\x20.-][0-9]{3}[\x20.-][0-9]{4}", "0123456789+", "0123456789"), ("national_id", "[0-9]{3}-[0-9]{2}-[0-9]{4}", "0123456789-", "0123456789-")):
        end = 0
        for i in range(len(t)):
            if i < end or (i and t[i - 1] in before):
                continue
            for j in range(i + 1, min(len(t), i + 20) + 1):
                if re.fullmatch(pattern, t[i:j]) and not (j < len(t) and t[j] in after):
                    out.append((kind, i, j))
                    end = j
                    break
    kept = []
    for kind, a, b in out:
        near = t[max(0, a - 40) : a].lower() + " " + t[b : b + 40].lower()
        score = {"iban": 0.8}.get(kind, 0.4) + 0.25 * any(w in near for w in CONTEXT[kind]) - 0.3 * any(w in near for w in AGAINST)
        if score >= 0.6:
            kept.append((kind, a, b))
    return sorted(kept)


def test_added_personal_kinds_against_trying_every_span():
    rng = random.Random(2)
    pieces = ["DE89370400440532013000", "DE89 3704 0044 0532 0130 00", "GB82WEST12345698765432", "NO9386011117947", " BIC ", "COBADEFFXXX", " ", "a", "Z", "7", "555-123-4567", "(555) 123.4567", "123-45-6789", "call ", "ssn ", "invoice ", "-", "+", "FR14", "."]
    hits = set()
    for _ in range(3000):
        t = "".join(rng.choices(pieces, k=rng.randint(1, 8)))
        found = sorted((k, a, b) for k, a, b, _ in find_personal(t) if k not in PII)
        assert found == plain_added(t), t
        hits |= {k for k, _, _ in found}
    assert hits == {"iban", "local_phone", "national_id"}


def test_numbers_with_many_zeros_and_ibans_before_capitals():
    text = "0" * 5000 + ".1.1.1 and 1." + "0" * 9000 + "255.3.4 but 1.2.3." + "9" * 6000
    assert sum(k == "ip" for k, *_ in find_personal(text)) == 2
    text = "IBAN DE89 3704 0044 0532 0130 00 BIC COBADEFFXXX"
    assert [text[a:b] for k, a, b, _ in find_personal(text) if k == "iban"] == ["DE89 3704 0044 0532 0130 00"]


def program(rng):
    """Random source code, and the places of the literals that reach a sensitive name."""
    words = ["alpha", "beta", "gamma", "delta", "home", "width"]
    secret = ["db_password", "apiKey", "AUTH_TOKEN", "passphrase"]
    text, known, reach, places = "", {}, {}, {}
    for n in range(rng.randint(1, 14)):
        names = [rng.choice(words + secret) for _ in range(rng.choice((1, 1, 1, 2)))]
        sources, value = set(), []
        for _ in range(rng.choice((1, 1, 2))):
            kind = rng.randint(0, 2)
            if kind and known:
                name = rng.choice(sorted(known))
                sources |= known[name]
                value.append((rng.choice((name, "$" + name, "${" + name + "}")), None))
            else:
                lit = f"{n}{len(value)}x-Q7" + "".join(rng.choices("aBcDeFgHiJkLm0123456789", k=14))
                value.append((f'"{lit}"', lit))
        style = rng.randint(0, 3)
        if style == 0 and len(names) == 1 and len(value) == 1 and value[0][1]:
            text += f"<{names[0]}>"
            places[value[0][1]] = len(text)
            text += value[0][1] + f"</{names[0]}>\n"
            value = [(None, value[0][1])]
        else:
            if style == 1 and len(names) == 1:
                text += f'conf["{names[0]}"] = '
            else:
                text += " = ".join(names) + (" = " if style != 2 or len(names) > 1 else ": ")
            for i, (shown, lit) in enumerate(value):
                text += " + " * bool(i)
                if lit:
                    places[lit] = len(text) + 1
                text += shown
            text += "\n"
        sources |= {lit for _, lit in value if lit}
        for name in names:
            known[name] = sources
            if name in secret:
                reach.update(dict.fromkeys(sources))
    return text, sorted((places[lit], places[lit] + len(lit)) for lit in reach)


def test_literals_of_random_programs():
    rng = random.Random(3)
    some = 0
    for _ in range(3000):
        text, want = program(rng)
        got = sorted((a, b) for k, a, b, _ in find_secrets(text) if k == "literal")
        assert got == want, text
        some += bool(want)
    assert some > 1000


@pytest.mark.parametrize("piece", ["a", "1", "1.", "@", "a@", "+1", "1 ", "A1", "(", "password=", "a=", "'", "x = y + ", "AB12 ", "a.b@c.", "a = ", "<a>", "--key a", "a=b", "AB12CD", "${a}", "'a'=", "x[\"a\"]="])
def test_long_runs_take_linear_time(piece):
    text = piece * 100_000
    start = time.perf_counter()
    find_personal(text), find_secrets(text)
    assert time.perf_counter() - start < 20


def test_checksums_and_context():
    assert luhn("4111111111111111") and not luhn("4111111111111112")
    assert mod97("GB82WEST12345698765432") and not mod97("GB82WEST12345698765433")
    kinds = lambda t: {k for k, *_ in find_personal(t)}
    assert "iban" in kinds("pay to GB82 WEST 1234 5698 7654 32 now") and "iban" not in kinds("GB83 WEST 1234 5698 7654 32")
    assert "local_phone" in kinds("call me: 555-123-4567") and "local_phone" not in kinds("part 555-123-4567")
    assert "national_id" in kinds("SSN 123-45-6789") and "national_id" not in kinds("lot 123-45-6789")
    score = lambda t: next(s for k, _, _, s in find_personal(t) if k == "card")
    assert score("credit card 4111111111111111") > score("4111111111111111") > score("invoice 4111111111111111")


def test_assignments_propagate():
    literal = lambda t: {t[a:b] for k, a, b, _ in find_secrets(t) if k == "literal"}
    assert literal("k = 'Zx81-qwErty_77'\ndb_password = k\n") == {"Zx81-qwErty_77"}
    assert literal("a = 'Zx81qwErty'\nb = a + '-77plmQ3x'\nclientSecret: b") == {"Zx81qwErty", "-77plmQ3x"}
    assert literal('{"apiKey": "9f8e7d6c5b4a3210ZZ"}') == {"9f8e7d6c5b4a3210ZZ"}
    parts = [f"Zx81qwErty-{i:03d}" for i in range(200)]
    assert literal("long = " + " + ".join(f"'{x}'" for x in parts) + "\na = long\nb = a\nsecret = b") == set(parts)
    chain = "v0 = 'Zx81-qwErty_77'\n" + "".join(f"v{i} = v{i - 1} + v{i - 1}\n" for i in range(1, 300))
    assert literal(chain) == set() and literal(chain + "password = v299") == {"Zx81-qwErty_77"}
    assert literal("k = 'Zx81-qwErty_77'\nk = 'other thing 42'\npassword = k") == {"other thing 42"}
    wide = "Zx81-" * 1000
    assert literal(f"secret = '{wide}'") == literal(f"{'n' * 500}_secret: {wide}") == {wide}
    assert literal("name = 'Zx81-qwErty_77'") == literal("password = 'changeme123'") == literal("token = ${TOKEN_VALUE_1}") == set()
    value = "f33e61Q83db5!dbdf"
    for source in (f'K="{value}"\nexport DB_PASSWORD=$K', f'K="{value}"\nDB_PASSWORD="${{K}}"', f'db_credential = cred = "{value}"', f'os.environ["SECRET_KEY"] = "{value}"', f"<password> {value}\n</password>", f"run --auth-token '{value}'", f"a=password='{value}'"):
        assert literal(source) == {value}, source
    assert literal("passphrase: correcthorsebatterystaple") == {"correcthorsebatterystaple"}
    assert literal("password: see the manual") == literal("<password>x</password>") == literal(f"pre-token {value}") == set()
    assert sensitivity("dbPassword") == sensitivity("DB_PASSWORD") == 1.0 and sensitivity("keyboard") == 0


def test_queries_nulls_and_clashing_columns(spark, docs):  # noqa: F811
    text = "éé mail a.b@c.de ip 1.2.3.4 token = 'abcdef123456789'"
    rows = [(1, None), (2, ""), (3, text), (3, text), (None, text), (4, "x " * 200_000 + text)]
    frame = docs(rows).selectExpr("*", "'q' as spans", "'q' as found", "'q' as kind")
    for digests, plain, kinds in ((personal_digests, plain_personal, PII), (secret_digests, plain_secrets, SECRETS)):
        found = digests(frame).collect()
        assert len(found) == len(rows)
        texts = {1: "", 2: "", 3: text, None: text, 4: "x " * 200_000 + text}
        for r in found:
            want = plain(texts[r["doc_id"]])
            line = ",".join(f"{k}:{a}:{b}" for k, a, b in want)
            assert r["base_sha256"] == hashlib.sha256(line.encode()).hexdigest()
            assert [r[f"n_{k}"] for k in kinds] == [sum(x[0] == k for x in want) for k in kinds]
            assert len(r["scores"].split(",")) == len(r["spans"].split(",")) and all(s.isdigit() for s in r["scores"].split(",") if s)
            assert set(line.split(",")) <= set(r["spans"].split(",")) or not line
        assert digests(docs([])).collect() == []
