"""Small helpers of these tests."""

from __future__ import annotations


def empty(df):
    return df.where("false")
