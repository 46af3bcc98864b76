"""Fixed values of the golden tests."""

# Stations in the order in which they are connected, each to the next.
STATIONS = [
    "Aotizhongxin",
    "Dongsi",
    "Guanyuan",
    "Wanshouxigong",
    "Tiantan",
    "Wanliu",
    "Gucheng",
    "Nongzhanguan",
    "Shunyi",
    "Huairou",
    "Changping",
    "Dingling",
]
CONNECTIONS = list(zip(STATIONS, STATIONS[1:]))

# PageRank of that chain at tolerance 0.0001.
CHAIN_RANKS = [
    0.252123, 0.466428, 0.648587, 0.803422, 0.935032, 1.046900,
    1.141988, 1.222813, 1.291514, 1.349910, 1.399547, 1.441738,
]

# A graph with cycles, a sink and a vertex nobody points to, and its ranks for 1..6.
CYCLIC_EDGES = [(1, 2), (2, 3), (3, 1), (1, 3), (4, 1), (5, 4), (3, 6)]
CYCLIC_RANKS = [1.489066858, 0.928038335, 1.716641697, 0.546218839, 0.295253426, 1.024780845]

# One reading per station; those above 150 are alerts.
STREAM_READINGS = {
    "Aotizhongxin": 80.0,
    "Changping": 45.0,
    "Dingling": 95.0,
    "Dongsi": 180.0,
    "Guanyuan": 160.0,
    "Gucheng": 200.0,
    "Huairou": 50.0,
    "Nongzhanguan": 70.0,
    "Shunyi": 60.0,
    "Tiantan": 55.0,
    "Wanliu": 40.0,
    "Wanshouxigong": 170.0,
}
STREAM_ALERTS = ["Dongsi", "Guanyuan", "Gucheng", "Wanshouxigong"]
