"""The cheapest edits that give a conversation a legal order of roles: bidirectional Dijkstra over the edit lattice.

A conversation is a text of codes, one per row: ``code_of(role, fault)``. A node of the lattice is a number of rows used
and a state of the order of roles; states are 0 (nothing kept), 1 (after system), 2 (after user), 3 (after assistant). An
edit leads from a node to one other node, so a text of edits belongs to one path, and the first edit in which
two equally cheap paths differ decides which is less.
"""

from heapq import heappop, heappush

# Costs and letters of the edits; what is wrong with a row, first fault first.
DELETE, INSERT, KEEP, REROLE = "D", "I", "K", "R"
COST = {KEEP: 0, REROLE: 1, DELETE: 2, INSERT: 5}
UNENDED = 5  # for a truncated row that stays
SOUND, TRUNCATED, BLANK, DUPLICATE = range(4)
ROLES = "sua"  # system, user, assistant; anything else is no legal role
START, FINAL = {0: 0}, {0: 0, 3: 0}
_ROWS_BITS = 40


def code_of(role: int, fault: int) -> str:
    """``role`` is its place in ``ROLES``, or 3 for any other."""
    return chr(65 + 4 * role + fault)


def _after(state: int, role: int) -> int | None:
    """The state after a row of that role, or None if it may not stand there."""
    if role == 0:
        return 1 if state == 0 else None
    if role == 1:
        return 2 if state in (0, 1, 3) else None
    return 3 if role == 2 and state == 2 else None


def _steps(code: str) -> list[list[tuple[str, int, int]]]:
    """Per state: the edits that use up a row of this code, in order of letters, as (letter, next state, cost)."""
    role, fault = divmod(ord(code) - 65, 4)
    stays = UNENDED if fault == TRUNCATED else 0
    steps = []
    for state in range(4):
        found = [(DELETE, state, COST[DELETE])]
        if fault in (SOUND, TRUNCATED):
            kept = _after(state, role)
            if kept is not None:
                found.append((KEEP, kept, COST[KEEP] + stays))
            found += [(REROLE, to, COST[REROLE] + stays) for to in (_after(state, 1), _after(state, 2)) if to is not None]
        steps.append(found)
    return steps


_CODES = [code_of(role, fault) for role in range(4) for fault in range(4)]
_FORWARD = {code: _steps(code) for code in _CODES}
_BACK = {code: [[(state, cost) for state in range(4) for _, to, cost in _FORWARD[code][state] if to == at] for at in range(4)]
         for code in _CODES}
_INSERTED = [2, 2, 3, 2]  # the state after an inserted row: a user, or an assistant after a user
_INSERTED_FROM = [[], [], [0, 1, 3], [2]]


def least_audit(codes: str, enter: dict[int, int] = START, leave: dict[int, int] = FINAL) -> tuple[int, str, int]:
    """Cost, edits and last state of the cheapest path; of equally cheap ones that with the least text of edits.

    ``enter`` and ``leave`` give states at the two ends and what each adds to the cost. The two searches take turns
    until no path of less or equal cost can be left: then every node of every cheapest path is settled from one
    side at least, so all crossings are known. The path is then read off from the front, least edit first.
    """
    rows = len(codes)
    ahead, behind = {}, {}  # tentative distances by node, rows * 4 + state
    front, back = [], []
    for state, cost in enter.items():
        ahead[state] = cost
        heappush(front, cost << _ROWS_BITS | state)
    for state, cost in leave.items():
        behind[rows * 4 + state] = cost
        heappush(back, cost << _ROWS_BITS | state)
    settled_ahead, settled_behind = {}, {}
    low = (1 << _ROWS_BITS) - 1
    best = None
    while front and back and (best is None or (front[0] >> _ROWS_BITS) + (back[0] >> _ROWS_BITS) <= best):
        if front[0] >> _ROWS_BITS <= back[0] >> _ROWS_BITS:
            entry = heappop(front)
            cost, node = entry >> _ROWS_BITS, entry & low
            if node in settled_ahead:
                continue
            settled_ahead[node] = cost
            row, state = node >> 2, node & 3
            reached = [(row * 4 + _INSERTED[state], cost + COST[INSERT])]
            if row < rows:
                reached += [(row * 4 + 4 + to, cost + paid) for _, to, paid in _FORWARD[codes[row]][state]]
            for other, total in reached:
                if total < ahead.get(other, total + 1):
                    ahead[other] = total
                    heappush(front, total << _ROWS_BITS | other)
                there = behind.get(other)
                if there is not None and (best is None or total + there < best):
                    best = total + there
            there = behind.get(node)
            if there is not None and (best is None or cost + there < best):
                best = cost + there
        else:
            entry = heappop(back)
            cost, turned = entry >> _ROWS_BITS, entry & low
            row, state = rows - (turned >> 2), turned & 3
            node = row * 4 + state
            if node in settled_behind:
                continue
            settled_behind[node] = cost
            reached = [(row * 4 + at, cost + COST[INSERT]) for at in _INSERTED_FROM[state]]
            if row:
                reached += [(row * 4 - 4 + at, cost + paid) for at, paid in _BACK[codes[row - 1]][state]]
            for other, total in reached:
                if total < behind.get(other, total + 1):
                    behind[other] = total
                    heappush(back, total << _ROWS_BITS | (rows - (other >> 2)) * 4 + (other & 3))
                there = ahead.get(other)
                if there is not None and (best is None or total + there < best):
                    best = total + there
    return _read_off(codes, enter, leave, settled_ahead, settled_behind, best)


def _edits(codes: str, node: int):
    row, state = node >> 2, node & 3
    steps = [(letter, row * 4 + 4 + to, paid) for letter, to, paid in _FORWARD[codes[row]][state]] if row < len(codes) else []
    return sorted([*steps, (INSERT, row * 4 + _INSERTED[state], COST[INSERT])])


def _read_off(codes: str, enter: dict, leave: dict, ahead: dict, behind: dict, best: int) -> tuple[int, str, int]:
    """The least cheapest path, from the settled distances of both sides. Rows inserted at the end are left to what follows."""
    left, end = {}, len(codes) * 4  # what a cheapest path still costs, for nodes on one
    for node in sorted(ahead, key=lambda n: (-ahead[n], -n)):
        if node >= end and ahead[node] + leave.get(node - end, best + 1) == best:
            left[node] = leave[node - end]
        elif node in behind:
            if ahead[node] + behind[node] == best:
                left[node] = behind[node]
        elif any(to in left and ahead[node] + paid + left[to] == best or ahead[node] + paid + behind.get(to, best + 1) == best
                 for _, to, paid in _edits(codes, node)):
            left[node] = best - ahead[node]
    node = min(state for state in enter if left.get(state, behind.get(state)) == best - enter[state])
    spent, letters = enter[node], []
    while not (node >= end and spent + leave.get(node - end, best + 1) == best):
        for letter, to, paid in _edits(codes, node):
            if spent + paid + left.get(to, behind.get(to, best + 1)) == best:
                letters.append(letter)
                node, spent = to, spent + paid
                break
    return best, "".join(letters), node & 3


def exit_costs(codes: str, enter: int) -> dict[int, int]:
    """The least cost from a state before these rows to each state after them that it can reach."""
    held = {enter: 0}
    for at in range(len(codes) + 1):
        for _ in range(2):  # inserted rows, at most two before states repeat
            for state, cost in list(held.items()):
                to = _INSERTED[state]
                if cost + COST[INSERT] < held.get(to, cost + COST[INSERT] + 1):
                    held[to] = cost + COST[INSERT]
        if at < len(codes):
            after: dict[int, int] = {}
            for state, cost in held.items():
                for _, to, paid in _FORWARD[codes[at]][state]:
                    if cost + paid < after.get(to, cost + paid + 1):
                        after[to] = cost + paid
            held = after
    return held
