"""Plain versions of operators, for small inputs."""

from collections import defaultdict


def shared_spans(docs, span):
    """docs: (id, text) rows."""
    texts = {i: t for i, t in docs if i is not None and t}
    held = defaultdict(set)
    for i, t in texts.items():
        for k in range(len(t) - span + 1):
            held[hash(t[k : k + span])].add(i)
    out = set()
    for i, t in texts.items():
        run = None
        for k in range(len(t) - span + 1):
            if len(held[hash(t[k : k + span])]) > 1:
                if run and k <= run[1]:
                    run[1] = k + span
                else:
                    if run:
                        out.add((i, *run))
                    run = [k, k + span]
        if run:
            out.add((i, *run))
    return out


def conversations(rows):
    """rows: (chat, msg, time, author, text, reply, service, batch) with copies that agree in time, author and reply."""
    messages = {}
    for chat, msg, at, author, text, reply, service, batch in rows:
        if service or chat is None or msg is None:
            continue
        seen = any(not c.isspace() and c not in "\u200b\u2800" for c in text or "")
        order = (batch is None, batch or 0, seen)
        old = messages.get((chat, msg))
        if old is None or order < old[0]:
            messages[chat, msg] = (order, at, author or "", reply or None, seen)
    trees, loose = defaultdict(list), set()
    for (chat, msg), x in messages.items():
        path, here = {msg}, msg
        while messages[chat, here][3] is not None and (chat, messages[chat, here][3]) in messages:
            here = messages[chat, here][3]
            if here in path:
                loose.add((chat, msg))
                break
            path.add(here)
        if (chat, msg) not in loose:
            trees[chat, here].append(msg)
    out = set()
    for (chat, root), some in trees.items():
        get = lambda m: messages[chat, m]  # noqa: B023, E731
        early = any(get(m)[3] is not None and (chat, get(m)[3]) in messages and None not in (get(m)[1], get(get(m)[3])[1]) and get(m)[1] < get(get(m)[3])[1] for m in some)
        if get(root)[3] is not None or early or not all(get(m)[4] for m in some) or len({get(m)[2] for m in some}) < 2:
            continue
        some.sort(key=lambda m: (get(m)[1] is not None, get(m)[1] or 0, m))
        out |= {(chat, root, m, k, "user" if get(m)[2] == get(root)[2] else "assistant") for k, m in enumerate(some, 1)}
    return out
