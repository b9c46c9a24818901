"""Streaming: intentionally empty.

The analyses this package rebuilds are one-shot batch queries over event
tables; none uses a watermark, trigger or streaming state. The wide table is
maintained by whole-column batch passes (see ``cohortkit.plans.widetable``),
which a scheduler can rerun as data arrives.
"""
