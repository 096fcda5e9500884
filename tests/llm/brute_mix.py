"""Targets of the mixing operator by the rule as it is told: share, stop, share the excess again."""


def targets(sizes, weights=(5, 2, 1), most=3):
    """sizes: source -> words. source -> target."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, room, excess = dict.fromkeys(names, 0.0), set(names), float(sum(sizes.values()))
    while room and excess > 1e-9:
        total = sum(weight[s] for s in room)
        for s in room:
            target[s] += excess * weight[s] / total
        excess = sum(max(0.0, target[s] - most * sizes[s]) for s in room)
        for s in list(room):
            if target[s] >= most * sizes[s]:
                target[s] = float(most * sizes[s])
                room.remove(s)
    return target
