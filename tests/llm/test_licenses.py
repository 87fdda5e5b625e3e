import re

from pageloom.llm import licenses

SCHEMA = "doc_id long, text string, found int, TEXT string"


def grams(text):
    words = re.sub(r"[\W_]+", " ", text.lower()).split()
    return set(zip(words, words[1:], strict=False)) if len(words) > 1 else set(words)


def brute(text):
    out = {}
    for unit in [text, *re.split(r"\n[ \t\r]*\n", text), *text.split("\n")]:
        for name, template in licenses.TEMPLATES:
            a, b = grams(unit), grams(template)
            score = 2.0 * len(a & b) / (len(a) + len(b))
            if score >= licenses.THRESHOLD:
                out[name] = max(out.get(name, 0), score)
    return sorted(out.items())


def test_units_against_brute_force(spark):
    full = dict(licenses.TEMPLATES)["MIT"]
    texts = [
        "Some prose.\nReleased under the MIT License.\nMore prose",
        "Copyright 2020 A. Writer\n\n" + full.replace(". ", ".\n") + "\n\nother words " * 30,
        full.replace("Software", "Programm").replace("copyright", "notice"),
        "this file is licensed under the apache license version 2 0 ok\nlicensed under cc by-nc 4.0!",
        "Licensed  under\tthe Apache-License (Version 2.0)",
        "nothing here\n\n\nMIT",
        "a b " * 5000,
        "é ß " * 10 + "\n \n",
        "",
        None,
    ]
    docs = spark.createDataFrame([(i, t, 1, "x") for i, t in enumerate(texts)] + [(None, texts[0], 1, "x"), (0, texts[0], 1, "x")], SCHEMA)
    got = licenses.scan(docs).collect()
    assert len(got) == len(texts) + 2
    for row in got:
        assert [(f.name, f.score) for f in row.found] == brute(texts[row.doc_id or 0] or "")
    assert licenses.scan(docs.where("false")).collect() == []


def runs(text):
    """Words of every run of neighbouring sentences, clauses and lines."""
    split = [p for p in re.split(r"\n|(?<=[.!?:;)])[ \t\r]+", text) if re.sub(r"[\W_]+", "", p)]
    return [" ".join(split[i:j]) for i in range(len(split)) for j in range(i + 1, len(split) + 1)]


def test_licences_inside_longer_texts(spark):
    short = [t for t in licenses.TEMPLATES if len(t[1]) < 2000]
    by_name = {}
    for name, t in short:
        by_name.setdefault(name, []).append(t)
    mit = by_name["MIT"][-1].replace("conditions: The", "conditions:\n\nThe").replace("Software. THE", "Software.\n\nTHE")
    gpl = by_name["GPL-3.0"][-1].replace("version. This", "version.\n\nThis").replace("details. You", "details.\n\nYou")
    code = "\n".join(f"def f{i}(x):\n    return x + {i}" for i in range(60))
    prose = " ".join(f"word{i} of the{i % 7}" for i in range(400))
    texts = [
        f"{prose}\n\n{mit}\n\n{prose}",
        f"{gpl}\n\n{code}",
        "# " + gpl.replace("\n", "\n# ") + f"\n{code}",
        "We sell reports. Released under the MIT License. See the site for more of them and other things to read.",
        "the license of the software " * 40,
    ]
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    got = {r.doc_id: {f.name: f.score for f in r.found} for r in licenses.scan(docs).collect()}
    assert [sorted(got[i]) for i in range(5)] == [["MIT"], ["GPL-3.0"], ["GPL-3.0"], ["MIT"], []]
    assert got[0]["MIT"] == got[1]["GPL-3.0"] == got[3]["MIT"] == 1.0
    small = [f"{code[:300]}\n{gpl[:-40]}\n\n{code[:200]}", texts[3], mit + "\n\nof the Software. " * 3 + mit[300:]]
    docs = spark.createDataFrame(list(enumerate(small)), "doc_id long, text string")
    for r in licenses.scan(docs, templates=short).collect():
        want = {}
        for unit in map(grams, runs(small[r.doc_id])):
            for name, t in short:
                score = 2.0 * len(unit & grams(t)) / (len(unit) + len(grams(t)))
                if score >= licenses.THRESHOLD:
                    want[name] = max(want.get(name, 0), score)
        assert [(f.name, f.score) for f in r.found] == sorted(want.items())


def test_full_texts(spark):
    full = [(i, f"{'some words before it ' * 20}\n\n{t}\n\n{'and after it ' * 20}") for i, (_, t) in enumerate(licenses.FULL)]
    for r in licenses.scan(spark.createDataFrame(full, "doc_id long, text string")).collect():
        assert (licenses.FULL[r.doc_id][0], 1.0) in [(f.name, f.score) for f in r.found]
