"""Asides are told apart at one recurrence in a corpus of any size, known to all tasks or joined."""

from __future__ import annotations

import random

from assayloom.llm import subjects

WORDS = {1: "enzyme kinase ligand receptor inhibitor", 2: "polymer resin monomer catalyst solvent", 3: "galaxy quasar nebula telescope redshift"}


def _assigned(spark):
    rng = random.Random(4)
    say = lambda s: "The " + " ".join(rng.choices(WORDS[s].split(), k=6)) + f" was {rng.choice(['seen', 'kept', 'given'])}."
    aside = ["The kinase receptor enzyme ligand inhibitor kinase was kept.", "The galaxy telescope nebula quasar redshift galaxy was kept."]
    docs, labels = [], []
    for d in range(480):
        own = d % 3 + 1
        body = [say(own) for _ in range(2)]
        # asides of another subject, more than a quarter of the sentences
        body += [a for k, a in zip((1, 3), aside) if k != own] if d % 20 == 0 else []
        docs.append((d, " ".join(body), "s"))
        labels += [(d, own)]
    df = spark.createDataFrame(docs, "doc_id long, text string, source string")
    got = subjects.assign_subjects(df, spark.createDataFrame(labels, "doc_id long, subject_id int"), spark.createDataFrame([(1,), (2,), (3,)], "subject_id int"))
    return sorted(map(tuple, got.collect())), labels


def test_asides_do_not_depend_on_how_many_a_task_may_know(spark, monkeypatch):
    passed = []
    measured = subjects._with_asides
    monkeypatch.setattr(subjects, "_with_asides", lambda docs, recurring: (passed.append(recurring.count()), measured(docs, recurring))[1])
    known, truth = _assigned(spark)
    assert not passed
    monkeypatch.setattr(subjects, "ASIDES", 0)
    joined, _ = _assigned(spark)
    assert passed and passed[0] > 0, passed
    assert joined == known
