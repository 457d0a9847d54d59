"""Stops a job after each single change it makes to the file system or the catalog, one run at a time."""

from __future__ import annotations

from contextlib import contextmanager
from dataclasses import dataclass
from unittest import mock

from tierwise import scratch
from tierwise.sources import catalog

CHANGES = [(scratch, n) for n in ("delete", "rename", "write_text", "write_once")] + [(catalog, "change")]


class Stopped(Exception):
    pass


@dataclass
class Run:
    root: str
    after: int
    stopped: bool = False

    @contextmanager
    def stopping(self):
        """Let ``after`` changes through; the next one, already made or not, is the last thing seen."""
        left = self.after

        def counted(real):
            def call(*args):
                nonlocal left
                if left == 0:
                    raise Stopped
                left -= 1
                return real(*args)

            return call

        patches = [mock.patch.object(where, name, counted(getattr(where, name))) for where, name in CHANGES]
        for patch in patches:
            patch.start()
        try:
            yield
        except Stopped:
            self.stopped = True
        finally:
            for patch in patches:
                patch.stop()


def steps_until_done(tmp_path, every=1):
    """(number, run) for a run that stops at once, after ``every`` more changes, and so on, until one is not stopped."""
    for after in range(0, 100, every):
        run = Run(f"{tmp_path}/stop{after}", after)
        yield after, run
        if not run.stopped:
            return
