import random

import pytest

from namesmith.operators import records, resolution
from namesmith.operators.knowledge import default
from namesmith.sources.files import NAMES
from namesmith.storage import durable, ship
from namesmith.streaming import incremental


def test_stream(spark, tmp_path):
    spark.createDataFrame([(1, "'SUPER ANDES S A"), (2, "'OTRO NOMBRE")], NAMES).write.parquet(str(tmp_path / "in"))
    master = spark.createDataFrame([("ANDES SUPER", "c1")], "clave string, cluster string")
    stream = spark.readStream.schema(NAMES).parquet(str(tmp_path / "in"))
    incremental.start(stream, master, [], str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(60)
    got = {r.idx: r.cluster for r in spark.read.parquet(str(tmp_path / "out")).collect()}
    assert got == {1: "c1", 2: None}


def one_run(names, statistics):
    rows = durable(records.keyed(records.first_pass(names, default()), statistics.generic, default()), "rows")
    node = durable(resolution.nodes(rows), "nodes")
    rare = durable(resolution.rare_tokens(node, statistics.frequency), "rare")
    pairs = durable(resolution.decide(resolution.candidate_pairs(resolution.signals(rare)), node, rare, statistics.cut), "pairs")
    return {(r.clave, r.cluster) for r in resolution.clusters(resolution.guarded_clusters(pairs, node, statistics.generic), node).collect()}


def test_loads_make_one_run(spark, tmp_path):
    """New keys, better texts of known ones, a block that grows beyond use; a load that dies half-way and is done again."""
    ship(spark)
    rng = random.Random(3)
    first, second = ["ANDES", "ISTMO", "CORDILLERA", "MANANTIAL"], ["BELLAVISTA", "CENTRAL", "DORADO"]
    word = lambda: "".join(rng.choice("ABCDEFGLMNORST") for _ in range(7))
    base = [f"{rng.choice(first)} {rng.choice(second)} {word()}" for _ in range(60)]
    texts = [t + rng.choice(["", "S", " S A", "X", ""]) for t in base * 4] + [f"COMUNISIMO {word()} {word()}" for _ in range(140)]
    texts += ["ASOCIACION DE CRIADORES DE GANADO DE", "ASOCIACION DE CRIADORES DE GANADO DE CHIRIQUI"]
    rng.shuffle(texts)
    names = spark.createDataFrame([(k, "'" + t) for k, t in enumerate(texts)], NAMES)
    frequency = durable(records.document_frequency(records.first_pass(names)), "frequency")
    statistics = incremental.Statistics(frequency.where("token <> 'DORADO'"), [], 400)
    master = incremental.Master(spark, f"file://{tmp_path}/master", statistics)
    for load in range(3):
        part = names.where(f"idx >= {load * 130} and idx < {(load + 1) * 130 if load < 2 else 10**6}")
        part.write.parquet(f"{tmp_path}/in/{load}")
        stream = spark.readStream.schema(NAMES).option("recursiveFileLookup", "true").parquet(f"{tmp_path}/in")
        if load == 1:
            whole, master._clustered = master._clustered, lambda *_: 1 / 0  # dies with most tables written
            with pytest.raises(Exception):
                incremental.maintain(stream, master, f"{tmp_path}/checkpoint").awaitTermination()
            master._clustered = whole
            assert not master.done(1)
        incremental.maintain(stream, master, f"{tmp_path}/checkpoint").awaitTermination()
        assert master.done(load)
        got = {(r.clave, r.cluster) for r in master.read("members", load).select("clave", "cluster").collect()}
        assert got == one_run(names.where(f"idx < {(load + 1) * 130 if load < 2 else 10**6}"), statistics)
    assert len({c for _, c in got}) < len(got)
    figures = master.drift().orderBy("carga").collect()
    assert [r.registros for r in figures] == [130, 130, len(texts) - 260] and sum(r.claves_nuevas for r in figures) == len(got)
    assert all(r.palabras_desconocidas > 0 for r in figures) and any(r.claves_mejoradas for r in figures)
    assert sorted(p.name for p in (tmp_path / "master" / "v=0").iterdir() if not p.name.startswith(".")) == ["drift"]
    master.load(names, 2)  # a load that is done isn't taken in again
    with pytest.raises(ValueError):
        master.load(names, 9)
