"""Readers: remote-write requests, agent batches, metric logs, the stored lake."""
