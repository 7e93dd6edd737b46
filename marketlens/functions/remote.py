"""Work-arrangement detection from text."""

from pyspark.sql import Column, functions as F

from marketlens.functions.text import WS, contains_any


def always_remote_type(description: Column, title: Column) -> Column:
    """remote, hybrid or onsite; hybrid needs a remote word as well."""
    text = F.lower(F.concat(description, F.lit(" "), title))
    # Remote and hybrid words of this feed.
    remote = contains_any(text, ["remote", "work from home", "wfh", "telecommute", "distributed"])
    hybrid = contains_any(text, ["hybrid", "flexible", "partial remote"])
    return F.when(remote & hybrid, "hybrid").when(remote, "remote").otherwise("onsite")


def maybe_remote_type(text: Column) -> Column:
    """remote, hybrid or NULL."""
    lowered = F.lower(text)
    # Remote words of this feed.
    remote = contains_any(lowered, ["remote", "work from home", "wfh", "distributed"])
    return F.when(remote & F.contains(lowered, F.lit("hybrid")), "hybrid").when(remote, "remote")


def remote_type_of_posting(lowered: Column) -> Column:
    """First of remote, hybrid, onsite that the lower-case posting text mentions."""
    # Words per arrangement; any "remote" wins over hybrid wording.
    remote = contains_any(lowered, ["remote", "work from home"])
    hybrid = contains_any(lowered, ["hybrid", "flexible work"])
    onsite = lowered.rlike(rf"on[-{WS}]?site|in[-{WS}]?office|office based")
    return F.when(remote, "remote").when(hybrid, "hybrid").when(onsite, "onsite")
