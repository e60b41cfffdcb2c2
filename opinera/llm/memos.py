"""What a worker keeps between tasks: the memos of one operator at a time."""

from collections.abc import Callable

_owner: list = [None, lambda: None]


def claim(owner: str, forget: Callable[[], None]) -> None:
    """From now on the worker's memos are this owner's; those of the one before are let go."""
    if _owner[0] != owner:
        _owner[1]()
    _owner[:] = [owner, forget]
