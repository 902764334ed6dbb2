"""What operators leave in the shared folder, and how it goes."""

import os
import threading

from cueweave.llm import common, token_store
from test_queries import PATH


def folders(spark):
    top = f"{common.shared_dir(spark).removeprefix('file:')}/cueweave"
    return set(os.listdir(top)) if os.path.isdir(top) else set()


def test_scratch_is_a_threads_own(spark):
    before, seen, started, go_on = folders(spark), [], threading.Event(), threading.Event()

    def other():
        with common.scratch():
            seen.append(common.materialize(spark.range(3).toDF("id"), "of-other"))
            started.set()
            go_on.wait(60)
            assert seen[0].count() == 3  # still there, though the main thread's scope has ended

    t = threading.Thread(target=other)
    t.start()
    started.wait(60)
    with common.scratch():
        common.materialize(spark.range(2).toDF("id"), "of-main")
        kept = common.materialize(spark.range(5).toDF("id"), "kept", keep=True)
    assert {n.split("-")[0] for n in folders(spark) - before} == {"of", "kept"}
    go_on.set()
    t.join()
    assert [n for n in folders(spark) - before if not n.startswith("kept")] == [] and kept.count() == 5


def test_tidy_leaves_nothing(spark):
    common.tidy(spark)
    before = folders(spark)
    left = common.materialize(spark.range(4).toDF("id"), "lazy")
    gone = common.materialize(spark.range(4).toDF("id"), "gone")
    common.discard(gone)
    token_store.store(spark.createDataFrame([(1, "some text")], "doc_id long, text string"), PATH).collect()
    assert left.count() == 4 and len(folders(spark) - before) == 2
    assert common.tidy(spark) == 2 and folders(spark) == before and common.tidy(spark) == 0
