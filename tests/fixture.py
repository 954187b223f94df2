"""A small statistics file with one of every fault."""

HEADER = (
    "partida_id,rodata,clube,chutes,chutes_no_alvo,posse_de_bola,passes,precisao_passes,"
    "faltas,cartao_amarelo,cartao_vermelho,impedimentos,escanteios\n"
)
ROWS = """\
1,1, São Paulo ,12,5,61%,420,85%,10,2,0,1,6
1,1,Grêmio,,,39%,,,,,,,
2,2,São Paulo,None,3,"61,5%",1.234,NaN,-5,1,1,12.0,4
x,,,3,1,50%,300,80%,9,,,0,2
3,2,"A, B",7
"""
NAN = float("nan")
CLEANED = [
    (1, "1", "São Paulo", 12, 5, 61.0, 420, 85.0, 10, 2, 0, 1, 6, 2023, 1),
    (1, "1", "Grêmio", 0, 0, 39.0, 0, 0.0, 0, 0, 0, 0, 0, 2023, 1),
    (2, "2", "São Paulo", 0, 3, 0.0, 1234, NAN, 5, 1, 1, 120, 4, 2023, 2),
    (None, None, None, 3, 1, 50.0, 300, 80.0, 9, 0, 0, 0, 2, 2023, None),
    (3, "2", "A, B", 7, 0, 0.0, 0, 0.0, 0, 0, 0, 0, 0, 2023, 2),
]


def write(folder):
    folder.mkdir(parents=True, exist_ok=True)
    path = folder / "statistics.csv"
    path.write_text(HEADER + ROWS, encoding="utf-8")
    return str(path)
