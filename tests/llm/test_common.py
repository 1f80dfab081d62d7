import os

import numpy as np

from shoreline.llm import common


def resident():
    with open("/proc/self/statm") as f:
        return int(f.read().split()[1]) * os.sysconf("SC_PAGE_SIZE")


def test_a_worker_keeps_no_freed_memory_after_its_task():
    """Blocks too small to be mapped one by one, and a last one that stays and so holds the heap's end."""
    stays = []

    def work(batches):
        for batch in batches:
            blocks = [np.ones(60 << 10, np.uint8) for _ in range(2000)]
            stays.append(blocks.pop())
            del blocks
            yield batch

    before = resident()
    assert list(common.handed_back(work)(iter([1, 2]))) == [1, 2]
    assert resident() - before < 40 << 20


def test_memory_is_handed_back_when_a_task_is_not_read_to_its_end():
    ended = []

    def work(batches):
        try:
            yield from batches
        finally:
            ended.append(True)

    first = common.handed_back(work)(iter([1, 2]))
    assert next(first) == 1
    first.close()
    assert ended == [True]
