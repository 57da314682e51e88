"""Repeating calls of an outside service by the kind of error, with a wait that all callers of an executor share.

A caller is in one of three states after an error: held (the service limits its callers: all wait, twice as long each time), slow (a
timeout or a lost connection: this caller waits, twice as long at each attempt) or failed (anything else: a short wait). A call that is answered
ends them all.
"""

from __future__ import annotations

import os
import tempfile
import time
from collections.abc import Callable
from dataclasses import dataclass, field

HELD, SLOW, FAILED = "held", "slow", "failed"


def kind_of(error: BaseException) -> str:
    """The state that an error leads to: by its HTTP status, its class, or the names of its classes."""
    status = getattr(error, "status_code", getattr(error, "status", getattr(error, "code", None)))
    names = " ".join(c.__name__.lower() for c in type(error).__mro__)
    if status == 429 or "ratelimit" in names or "toomanyrequests" in names:
        return HELD
    if isinstance(error, (TimeoutError, ConnectionError)) or "timeout" in names or "connection" in names or status in (408, 502, 503, 504):
        return SLOW
    return FAILED


@dataclass(frozen=True)
class Policy:
    """Waits in seconds: ``held_most`` bounds the shared wait, ``unit`` is the first of a doubling row and what a failed call waits.

    ``share_all``: every error makes the others wait, too, up to ``shared_most``.
    """

    attempts: int = 5
    unit: float = 1.0
    held_most: float = 30.0
    share_all: bool = False
    shared_most: float = 15.0

    def waits(self, kind: str, attempt: int, limits: int) -> tuple[float, float]:
        """(own wait, shared wait) after the attempt-th error, which is the limits-th of its row of limits."""
        if kind == HELD:
            return 0.0, min(self.unit * 2**limits, self.held_most)
        own = self.unit * 2**attempt if kind == SLOW else self.unit
        return own, min(own, self.shared_most) if self.share_all else 0.0


#: What the two extractor back ends do.
POLICIES = {"nim": Policy(), "gpt": Policy(held_most=60.0, share_all=True)}


class SharedWait:
    """A time before which nobody calls, in a small file that the Python workers of one machine share."""

    def __init__(self, name: str, folder: str | None = None):
        self.path = os.path.join(folder or tempfile.gettempdir(), f"graphloom-wait-{name}")

    def until(self) -> float:
        try:
            return os.stat(self.path).st_mtime
        except FileNotFoundError:
            return 0.0

    def hold(self, until: float) -> None:
        """Never shortens a wait that another caller has set."""
        if until > self.until():
            with open(self.path, "a"):
                os.utime(self.path, (until, until))


@dataclass
class Caller:
    """One task's calls under a policy; ``clock`` and ``sleep`` can be replaced in tests."""

    policy: Policy = field(default_factory=Policy)
    shared: SharedWait | None = None
    clock: Callable[[], float] = time.time
    sleep: Callable[[float], None] = time.sleep
    limits: int = 0

    def call(self, what: Callable[[], str]) -> str:
        """The call's answer; empty after the last attempt."""
        for attempt in range(self.policy.attempts):
            while self.shared and (left := self.shared.until() - self.clock()) > 0:
                self.sleep(left)
            try:
                answer = what()
                self.limits = 0
                return answer
            except Exception as error:  # noqa: BLE001 - whatever an outside service raises is an error of one of the kinds
                kind = kind_of(error)
            if attempt + 1 == self.policy.attempts:
                break
            own, others = self.policy.waits(kind, attempt, self.limits)
            self.limits += kind == HELD
            if others and self.shared:
                self.shared.hold(self.clock() + others)
            elif others:
                own = max(own, others)
            if own:
                self.sleep(own)
        return ""
