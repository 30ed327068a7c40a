"""What to do when a step fails: wait and try again, or set the rows aside."""

from __future__ import annotations

import time
from collections.abc import Callable

#: Answers of a service that mean it may work later.
TRANSIENT_STATUS = (429, 500, 502, 503, 504)
MAX_DATA_TRIES, LONGEST_WAIT = 3, 30.0


class DataError(Exception):
    """Trying again will not help."""


def status_of_failure(status: int | None) -> int:
    """How a failed call to an embedding service is answered: a client's error is one of the
    request, being limited, a server's error and no answer mean that the service isn't there."""
    return 400 if status is not None and 400 <= status < 500 and status != 429 else 503


def is_transient(error: Exception) -> bool:
    return isinstance(error, (ConnectionError, TimeoutError)) or getattr(error, "status", None) in TRANSIENT_STATUS


def wait_before(attempt: int, transient: bool, base: float = 1.0) -> float:
    """Seconds before try number ``attempt`` + 1 (the first is 1)."""
    return min(LONGEST_WAIT, base * 2 ** min(attempt, 5)) if transient else base * 2 ** (attempt - 1)


def run(step: Callable[[], object], set_aside: Callable[[Exception], object], base: float = 1.0, sleep: Callable[[float], None] = time.sleep):
    """The step's result. Transient errors are tried again without limit, others MAX_DATA_TRIES
    times, after which ``set_aside`` has the error (for instance to write the batch to quarantine)."""
    tries = data_tries = 0
    while True:
        try:
            return step()
        except Exception as e:  # noqa: BLE001
            tries += 1
            transient = is_transient(e)
            data_tries += not transient
            if data_tries >= MAX_DATA_TRIES:
                return set_aside(e)
            sleep(wait_before(tries if transient else data_tries, transient, base))
