"""Knowledge as tables: large ones against plain Python, odd rows, plans that don't grow."""

import random
import time

from namesmith.operators import sectors, vocabulary
from namesmith.operators.knowledge import Knowledge, default

CORES = "idx long, nucleo string, tokens array<string>, sufijo_societario string"


def cores(spark, texts):
    return spark.createDataFrame([(k, t, None if t is None else t.split(), "") for k, t in enumerate(texts)], CORES)


def test_phrases_against_plain_search(spark):
    r = random.Random(5)
    word = lambda: "".join(r.choice("ABCE") for _ in range(r.randint(1, 5)))
    phrases = sorted({" ".join(word() for _ in range(r.randint(1, 3))) for _ in range(1000)})
    texts = sorted({" ".join(word() for _ in range(r.randint(0, 8))) for _ in range(400)}) + [" ".join(word() for _ in range(3000))]

    def plain(t):
        held = [p for p in phrases if p in t]
        return min(held, key=lambda p: (-len(p), t.index(p))) if held else None

    df = spark.createDataFrame([(t,) for t in [*texts, None]], "text string")
    table = spark.createDataFrame([(p, k) for k, p in enumerate(phrases)], "phrase string, n long")
    got = {x.text: (x.phrase, x.n) for x in vocabulary.longest_phrase(df, table).collect()}
    assert got == {t: (plain(t), phrases.index(plain(t))) for t in texts if plain(t)}
    assert vocabulary.longest_phrase(df, table.where("false")).count() == 0
    assert vocabulary.longest_phrase(df.where("false"), table).count() == 0


def test_large_tables(spark):
    """5,000 words and 1,000 phrases: the rows of the cascade by expressions; the plan is as long as for ten keys."""
    r = random.Random(7)
    stem = lambda n: "".join(r.choice("BCDFGLMNPRST") + r.choice("AEIOU") for _ in range(n))
    words = sorted({stem(r.randint(2, 6)) for _ in range(6000)} - set(default().words))[:5000]
    r.shuffle(words)
    sector = lambda: r.choice([("A", "01"), ("G", "47"), ("C", "10")])
    rows = [(w, *sector(), r.randint(1, 9)) for w in words]
    # Phrases of one length each: of equally long ones within a text the two cascades may choose differently.
    rows += [(p, *sector(), 8) for p in {f"{r.choice(words)} {r.choice(words)}" for _ in range(1000)}]
    knowledge = Knowledge(catalogue=rows, gazetteer=[("BANCO " + words[0], "Uno", "K", "64"), (words[1], "Dos", "J", "61")])
    near = lambda w: r.choice([w, w + "S", w[:-1], w + "N"])
    texts = [" ".join(near(r.choice(words)) for _ in range(r.randint(1, 4))) for _ in range(300)]
    held = [p.key for p in r.sample(knowledge.phrases, 60)]
    texts += [f"{stem(2)}X {p}" for p in held] + ["PH " + stem(3) + "X", "BANCO " + words[0], "EL " + words[1], "", None, "ZZZ", words[2], words[2]]
    df = cores(spark, texts)
    columns = ["idx", "nivel", "evidencia", "seccion", "division", "peso"]
    began = time.monotonic()
    made = vocabulary.cascade(df, *vocabulary.tables(spark, knowledge)).select(columns)
    seconds = time.monotonic() - began
    got, want = ({x.idx: tuple(x) for x in rows.collect()} for rows in (made, sectors.cascade(df.where("nucleo is not null"), knowledge).select(columns)))
    assert len(got) == len(texts) and set(got) - set(want) == {texts.index(None)}
    assert got[texts.index(None)][1] == "sin_evidencia"
    differ = [(texts[k], got[k], want[k]) for k in want if got[k] != want[k]]
    assert not differ, (differ[:5], len(differ))
    assert {x[1] for x in got.values()} >= {"frase", "token", "token_aproximado", "gazetteer", "propiedad_horizontal", "sin_evidencia"}
    small = vocabulary.cascade(df, *vocabulary.tables(spark, default()))
    size = lambda x: len(x._jdf.queryExecution().analyzed().toString())
    assert size(made) < size(small) * 1.1 and seconds < 60


def test_odd_tables(spark):
    """Keys that are null, empty, repeated or written otherwise; clashing columns; repeated rows; a third of all rows alike."""
    df = cores(spark, ["LUNA FERRETERIA", "FERRETERIA", "LUNA", *["MINI SUPER LUNA"] * 200]).selectExpr("*", "'x' as nivel", "1 as text", "2 as key", "3 as phrase", "4 as _n")
    catalogue = spark.createDataFrame(
        [(1, None, "A", "01", 9, "p"), (2, "", "A", "01", 9, "p"), (3, "Ferretería", "G", "46", 9, "p"), (4, "FERRETERIA", "G", "47", 8, "q"), (5, "MINI  SUPER", "G", "47", 8, "q")],
        "orden int, key string, section string, division string, weight int, text string",
    )
    none = spark.createDataFrame([], "key string, name string, section string, division string")
    rows = vocabulary.cascade(df, catalogue, none).orderBy("idx").collect()
    assert [(r.nivel, r.evidencia, r.division, r.peso) for r in rows[:4]] == [("token", "FERRETERIA", "47", 8), ("token", "FERRETERIA", "47", 8), ("sin_evidencia", "", "", 5), ("frase", "MINI SUPER", "47", 5)]
    assert len(rows) == 203 and rows[0].text == 1 and len({r[5:] for r in rows[3:]}) == 1
    assert {r.nivel for r in vocabulary.cascade(df, catalogue.where("false"), none).collect()} == {"sin_evidencia"}
    assert vocabulary.cascade(df.where("false"), catalogue, none).count() == 0
