import json

from chatmill import cli
from chatmill.plans import pipeline
from chatmill.sources import exports

BASE = 1_767_225_600
LONG = "Коллеги, docker контейнер с python сервисом падает при старте, помогите разобраться почему так выходит"


def export(folder, rows):
    folder.mkdir()
    raw = [{"id": k + 1, "type": "message", "date_unixtime": str(BASE + at), "from": who, "from_id": f"u_{who}", "text": text, **({"reply_to_message_id": reply} if reply else {})} for k, (at, who, text, reply) in enumerate(rows)]
    (folder / "result.json").write_text(json.dumps({"messages": raw[::-1]}), encoding="utf-8")


def test_from_exports_to_tables(spark, tmp_path, capsys):
    export(tmp_path / "ChatExport_a", [(0, "Анна", LONG + "?", None), (60, "Борис", "Посмотри логи nginx и docker compose, обычно там видно причину падения сервиса. Проверь память!", 1), (120, "Анна", "спасибо, помогло, пиши на anna@mail.example", 2), (180, "Вера", "ну ок тогда", 2), (100000, "Вера", LONG.replace("помогите", "подскажите"), None)])
    export(tmp_path / "ChatExport_b", [(200000, "Глеб", "Совсем другой длинный текст про налоги, договор и бухгалтерию", None), (200100, "Глеб", "совсем другой длинный ТЕКСТ про налоги, договор и бухгалтерию!", None)])
    counts = pipeline.run(spark, [str(tmp_path / "ChatExport_a"), str(tmp_path / "ChatExport_b")], str(tmp_path / "out"))
    assert counts["raw"] == 7 and counts["unique"] == 6 and counts["dialogues"] == 1
    full = spark.read.parquet(str(tmp_path / "out/full_clean_messages.parquet"))
    texts = [r.text_clean for r in full.collect()]
    assert not any("anna@" in t for t in texts) and any("[EMAIL_REDACTED]" in t for t in texts)
    assert pipeline.validate(spark, str(tmp_path / "out"))["overall_passed"]
    report = pipeline.analyse(full)
    assert report["volume"][0]["messages"] == counts["unique"] and len(report) == 26
    assert pipeline.compare(full, full)["overall_verdict"] == "stable"
    assert pipeline.audit_report(full)["categories"]
    lines = (tmp_path / "out/sft_sharegpt_format.jsonl").glob("part-*")
    assert json.loads("".join(p.read_text(encoding="utf-8") for p in lines).splitlines()[0])["conversations"][0]["from"] == "human"
    assert cli.main(["validate", str(tmp_path / "out"), "--report", str(tmp_path / "r.json")]) == 0
    assert cli.main(["search", str(tmp_path / "out/rag_knowledge_base.parquet"), "docker nginx падает"]) == 0
    assert json.loads((tmp_path / "r.json").read_text(encoding="utf-8"))["overall_passed"]


def test_names_are_redacted(spark, tmp_path):
    export(tmp_path / "ChatExport_n", [(0, "Анна", "Передай это, пожалуйста, борис: сервер снова упал", None), (60, "Борис", "Forwarded from Gleb_N: спроси Анна про отчёт", None), (120, "анна", "переслано от Gleb_N. и postgres://u:p@host/db", None), (180, "Борис", "Forwarded from u_Борис", None)])
    rows = pipeline.clean(exports.read_exports(spark, [str(tmp_path / "ChatExport_n")]))
    assert [r.text_clean for r in rows.orderBy("msg_id").collect()] == [
        "Передай это, пожалуйста, [PERSON_REDACTED]: сервер снова упал", "Forwarded from Developer_00004: спроси [PERSON_REDACTED] про отчёт",
        "Forwarded from Developer_00004. и [DATABASE_URL_REDACTED]", "Forwarded from Developer_00002",
    ]
