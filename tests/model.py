"""Row-by-row models that the distributed operators must agree with."""

from __future__ import annotations


def slug(symbol, name):
    base = symbol.lower().strip()
    if name and name.upper() != symbol:
        return base + "-" + "".join(c for c in name.lower() if c.isalnum() or c == "-")[:20]
    return base


class Resolver:
    """Resolves one record after the other; later records see what earlier ones created."""

    def __init__(self, coins=(), mappings=()):
        self.coins = {coin_id: (symbol, None) for coin_id, symbol in coins}
        self.mappings = {(source, sid): (coin_id, None, None) for source, sid, coin_id in mappings}
        self.old_coins, self.old_mappings = set(self.coins), set(self.mappings)

    def resolve(self, source, sid, symbol, name):
        if (source, sid) in self.mappings:
            return self.mappings[source, sid][0]
        same = [coin_id for coin_id, (s, _) in self.coins.items() if s == symbol]
        if same:
            self.mappings[source, sid] = (same[0], symbol, name)
            return same[0]
        coin_id = max(self.coins, default=0) + 1
        self.coins[coin_id] = (symbol, name or symbol)
        self.mappings[source, sid] = (coin_id, symbol, name or symbol)
        return coin_id

    def new_coins(self):
        return sorted(
            (coin_id, symbol, name, slug(symbol, name))
            for coin_id, (symbol, name) in self.coins.items()
            if coin_id not in self.old_coins
        )

    def new_mappings(self):
        fresh = {k: v for k, v in self.mappings.items() if k not in self.old_mappings}
        return sorted(
            ((coin_id, source, sid, symbol, name) for (source, sid), (coin_id, symbol, name) in fresh.items()),
            key=str,
        )


def id_map(raw):
    """raw: (source, raw_symbol, raw_id) in order."""
    found = {}
    for source, symbol, raw_id in raw:
        if raw_id and symbol:
            found[source, symbol.upper()] = raw_id
    return found


def upsert(target, batch, keys, updates):
    table = {tuple(r[k] for k in keys): dict(r) for r in target}
    last = {tuple(r[k] for k in keys): r for r in batch}
    for key, row in last.items():
        if key in table:
            table[key].update({c: row[c] for c in updates})
        else:
            table[key] = dict(row)
    return table
