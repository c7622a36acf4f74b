"""Redaction rules on hand-made text, nested values and JSON text."""

from tickerlake.operators.privacy import redact_map, redact_secrets

R = "***REDACTED***"


def red(spark, text, **kw):
    df = spark.createDataFrame([(text,)], "t string")
    return redact_secrets(df, "t", **kw).collect()[0].t


def test_password_forms(spark):
    assert red(spark, "conn password='hunter2' x") == f"conn password='{R}' x"
    assert red(spark, "PASSWORD=\"abc\"") == f"password='{R}'"
    # Rules run in their fixed order: the query-parameter rule rewrites the
    # leading "&" that the "&password=..&" rule leaves, as the original does.
    assert red(spark, "u?user=a&password=abc&x=1") == f"u?user=a?password={R}&x=1"


def test_url_query_and_tokens(spark):
    assert red(spark, "see https://h.example.com/p?a=1&b=2 now") == f"see https://h.example.com/p?{R} now"
    assert red(spark, "token=abc123 rest") == f"token='{R}' rest"
    assert red(spark, 'token = "abc"') == 'token = "abc"'
    assert red(spark, 'token = "abc"', loose_token=True) == f"token = '{R}'"


def test_log_forms(spark):
    assert red(spark, "{'password': 'x'}", log_forms=True) == f"{{'password': '{R}'}}"
    assert red(spark, '{"password": "x"}', log_forms=True) == f'{{"password": "{R}"}}'


def test_unicode_spaces_and_letters(spark):
    assert red(spark, "token=abc\u3000next words") == f"token='{R}'\u3000next words"
    assert red(spark, "see https://h/p?a=1\u00a0now") == f"see https://h/p?{R}\u00a0now"
    assert red(spark, "PA\u017f\u017fWORD='q'") == f"password='{R}'"
    assert red(spark, "to\u212aen=x\x1cy") == f"token='{R}'\x1cy"
    assert red(spark, "?password=a\x85b") == f"?password={R}\x85b"


def python_rules(text):
    """The rules as the original applies them."""
    import re

    text = re.sub(r"password=['\"]([^'\"]+)['\"]", f"password='{R}'", text, flags=re.IGNORECASE)
    text = re.sub(r"&password=[^&]+&", f"&password={R}&", text, flags=re.IGNORECASE)
    text = re.sub(r"[?&]password=[^&\s]+", f"?password={R}", text, flags=re.IGNORECASE)
    text = re.sub(r"(https?://[^\s?]+)\?[^\s]+", rf"\1?{R}", text)
    return re.sub(r"token=['\"]?[^'\"&\s]+['\"]?", f"token='{R}'", text, flags=re.IGNORECASE)


def test_every_space_and_letter_case_as_in_python(spark):
    spaces = [chr(c) for c in range(0x110000) if not 0xD800 <= c < 0xE000 and (chr(c).isspace() or c in (0x200B, 0xFEFF, 0x180E, 0x00AD))]
    texts = [f"{word}=ab{s}cd https://h/x?y{s}z &password=q{s}r" for s in spaces for word in ("token", "ToKeN", "to\u212aen", "pa\u017fsword")]
    rows = redact_secrets(spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string"), "t").collect()
    assert {r.i: r.t for r in rows} == {i: python_rules(t) for i, t in enumerate(texts)}


def jred(spark, text, **kw):
    return redact_map(spark.createDataFrame([(text,)], "t string"), "t", **kw).collect()[0].t


def test_json_text_any_depth_and_exact(spark):
    assert jred(spark, '{"Password": "p", "n": 1.50, "conn": {"password": {"a": [1, "}"]}, "x": null}}') == (
        f'{{"Password": "{R}", "n": 1.50, "conn": {{"password": "{R}", "x": null}}}}')
    assert jred(spark, '{"token" :  1 , "b": "\\"token\\": 1"}') == f'{{"token" :  "{R}" , "b": "\\"token\\": 1"}}'
    assert jred(spark, '{"to\\u006ben": [1, {"x": 2}], "l": [{"secret": 1}]}') == f'{{"to\\u006ben": "{R}", "l": [{{"secret": 1}}]}}'
    assert jred(spark, '{"a": {}, "pwd": {}}') == f'{{"a": {{}}, "pwd": "{R}"}}'
    for kept in ("not json password=1", "[1,2]", "", None, "{\"password\": ", "{}", "{\"a\": {\"b\": 1}}"):
        assert jred(spark, kept) == kept
    deep = "{\"a\": " * 5000 + '{"secret": "s"}' + "}" * 5000
    assert jred(spark, deep) == deep.replace('"s"', f'"{R}"')
    assert jred(spark, '{"k": 1, "token": 2}', keys=["K"]) == f'{{"k": "{R}", "token": 2}}'


def test_json_text_equals_recursion_over_values(spark):
    import json
    import random

    from tickerlake.schema import SENSITIVE_KEYS

    def clean(d):
        return {k: R if k.lower() in SENSITIVE_KEYS else clean(v) if isinstance(v, dict) else v for k, v in d.items()}

    rnd = random.Random(5)

    def make(depth):
        kinds = [lambda: rnd.choice(["x", 'a"b', "}", "\\", "\u00e9"]), lambda: rnd.random(), lambda: None, lambda: True, lambda: [1, {"token": 2}, "]"]]
        if depth:
            kinds += [lambda: {rnd.choice(["a", "Token", "PWD", "b", "auth", 'q"', "c"]): make(depth - 1) for _ in range(rnd.randint(0, 4))}] * 4
        return rnd.choice(kinds)()

    rows = [{"r": make(4), "Secret": make(1)} for _ in range(300)]
    df = spark.createDataFrame([(i, json.dumps(r, indent=rnd.choice([None, 1]), ensure_ascii=rnd.random() < 0.5)) for i, r in enumerate(rows)], "i int, t string")
    got = {r.i: json.loads(r.t) for r in redact_map(df, "t").collect()}
    assert got == {i: clean(r) for i, r in enumerate(rows)}


def test_typed_columns_keep_their_types(spark):
    df = spark.sql("""SELECT named_struct('Password', 1, 'n', 2, 'in', named_struct('token', array(1), 'm', map('auth', 'x', 'b', 'y')),
                      'l', array(named_struct('secret', 1))) AS v, map('Token', 5, 'k', 6) AS m, map('a', map('pwd', 'p', 'q', 'r')) AS mm""")
    r = redact_map(redact_map(redact_map(df, "v"), "m"), "mm").collect()[0]
    assert r.v.Password == R and r.v.n == 2 and r.v["in"].token == R and r.v["in"].m == {"auth": R, "b": "y"} and r.v.l[0].secret == 1
    assert r.m == {"Token": None, "k": 6} and r.mm == {"a": {"pwd": R, "q": "r"}}
