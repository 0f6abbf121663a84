"""A feed for the paged data source's tests."""


def fetch(combination, page):
    if combination.get("bad"):
        raise ValueError("no JSON")
    n = combination["n"]
    return [{"id": f"{combination['year']}-{page}-{i}", "page": page} for i in range(min(2, n - 2 * (page - 1)))] if page <= (n + 1) // 2 else []


def other(combination, page):
    return [{"id": "from the list", "page": None}] if page == 1 else []
