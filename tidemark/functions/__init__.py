"""Scalar functions as native Column expressions; none of them runs Python on the executors."""

from tidemark.functions.scalars import *  # noqa: F403
