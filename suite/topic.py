"""One topic's queries and check SQL."""

from fixtures import domain


def topic():
    """(queries, oracles, register): ``register(name, sql)`` adds a function of the domain under both."""
    queries, oracles = {}, {}

    def register(name, oracle=None):
        def add(fn):
            queries[name] = lambda spark, sf_dir: fn(domain(spark, sf_dir))
            if oracle:
                oracles[name] = oracle
            return fn
        return add
    return queries, oracles, register
