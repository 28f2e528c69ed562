"""Word lists and training sentences of the personal-data field (``personal``). Lists are features only: nothing is found or passed over by them alone.

The sentences are written for this purpose. None of them is taken from a table (``tests/llm`` searches the test tables for each).
"""

from __future__ import annotations

import random
import re
from collections.abc import Iterator

# Common given names, without accents.
GIVEN = set("""
adriana adriano alberto alessandra alexandre alice aline amanda ana andre andrea antonia antonio arthur augusto barbara beatriz bernardo bianca bruna bruno
caio camila carla carlos carolina catarina cecilia cesar claudia claudio clara cristiane cristina daniel daniela danilo davi debora denise diego
eduarda eduardo elaine elena eliana elisa fabiana fabio felipe fernanda fernando flavia flavio francisca francisco gabriel gabriela geraldo guilherme gustavo
heitor helena henrique hugo igor ines isabel isabela ivan jaime jessica joana joao joaquim jorge jose juliana julia julio karina larissa laura leandro leonardo
leticia lidia luana lucas lucia luciana luis luisa luiz luiza manuel marcela marcelo marcia marcio marcos margarida maria mariana marina mario marta mateus
mauricio miguel monica natalia nelson nuno olga otavio patricia paula paulo pedro priscila rafael rafaela raquel raul regina renata renato ricardo rita roberta roberto
rodrigo rogerio ronaldo rosana rui sandra sara sebastiao sergio silvia simone sofia sonia susana tania tatiana teresa thiago tiago valeria vanessa vera vicente victor vinicius vitor
raimundo josefa edson emerson gilson wagner wellington severino severina rosangela luzia lourdes jefferson kelly gilmar walter edna marlene irene sueli ali john mary james anna peter juan carmen pierre marie giovanni
""".split())  # fmt: skip
# Common family names, without accents.
SURNAMES = set("""
silva santos oliveira souza sousa rodrigues ferreira alves pereira lima gomes costa ribeiro martins carvalho almeida lopes soares fernandes vieira barbosa rocha dias nascimento
andrade moreira nunes marques machado mendes freitas cardoso ramos goncalves santana teixeira araujo melo pinto correia correa castro cavalcanti moura campos batista farias
monteiro reis duarte borges barros peixoto tavares azevedo coelho cunha fonseca leal macedo magalhaes matos miranda morais moraes neves nogueira pacheco paiva pires queiroz rezende sampaio
siqueira toledo vasconcelos xavier aguiar amaral antunes assis bastos braga brito caldas camargo chaves cordeiro dantas esteves fontes franca guerra guimaraes jesus leite lemos
abreu albuquerque alencar amorim bandeira barreto bezerra cabral carneiro cerqueira couto diniz falcao figueiredo freire furtado galvao lacerda lobo maia maciel medeiros mesquita mota muniz
pessoa pimentel prado rangel rego resende sales simoes torres trindade valente vargas veloso viana vidal sa paz luz garcia lopez martinez perez gonzalez hernandez smith johnson brown jones khan rossi russo bianchi dupont muller schmidt
""".split())  # fmt: skip
# Words that begin the name of a street, square or road.
STREET = set("rua r avenida av travessa tv trav praca pca largo alameda al estrada estr rodovia rod beco ladeira viela calcada calle via rue street road avenue plaza piazza paseo quadra sqn sqs shis shin scs scn qnm qnl crs sgas".split())
# Words at which the name of a place, institution, work or feast begins or ends.
PLACE = set("""
sao santo santa dom nossa senhor bom porto rio vila alto baixo monte barra lagoa campo montes campos aguas serra praia bairro cidade parque capela nova novo velha velho mata morro ilha pedra ponta fonte costa vale jardim
hospital escola clube igreja colegio instituto fundacao ponte praca rua avenida estadio aeroporto universidade faculdade teatro museu biblioteca banco ministerio secretaria tribunal supremo camara senado prefeitura
partido associacao sindicato federacao confederacao conselho comissao departamento policia guarda radio tv jornal revista folha diario canal portal programa projeto operacao copa liga torneio feira festa festival
estado republica governo banda grupo empresa companhia rede loja mercado shopping hotel edificio condominio fazenda sitio estacao linha santuario catedral convento palacio forte marco dia semana lei plano sistema
""".split())  # fmt: skip
# Frequent words in which no name begins or ends.
PLAIN = set("""
o a os as ha so um uma uns umas de do da dos das em no na nos nas por pelo pela para com sem sob sobre ate desde entre contra apos ante perto longe e ou mas que quem quando onde como qual se ja nao sim so mais menos muito
todo toda todos todas este esta esse essa isto isso aquele aquela ele ela eles elas eu tu voce voces meu minha seu sua seus suas nosso nossa foi era sera ser estar esta estao tem tinha ter vai vao ir diz disse dizem conta
segundo conforme hoje ontem amanha agora depois antes ninguem alguem tudo nada mil outro outra cada sempre nunca tambem ainda porque pois entao assim aqui la veja leia ouca compartilhe repasse urgente atencao video foto audio imagem noticia mensagem post perfil pagina
the of and to in is on at for with los las el la del un una y en por con le les des du et il lo gli di che un
""".split())  # fmt: skip
# Months and days, without accents.
CALENDAR = set("janeiro fevereiro marco abril maio junho julho agosto setembro outubro novembro dezembro segunda terca quarta quinta sexta sabado domingo january february march april june july august september october november december".split())
TITLE = {"sr", "sra", "srta", "dr", "dra", "senhor", "senhora", "dona", "seu", "prof", "profa", "doutor", "doutora", "cidadao", "cidada"}
# Words beside which a person is often named.
ROLE = set("""
por chamado chamada autor autora vizinho vizinha morador moradora professor professora medico medica deputado deputada vereador vereadora prefeito prefeita senador senadora motorista enfermeira enfermeiro advogado advogada
paciente aluno aluna cliente colega amigo amiga irmao irma filho filha pai mae marido esposa tio tia primo prima testemunha vitima suspeito suspeita jornalista atleta cantor cantora ator atriz gerente sindico sindica
assina assinado nome contato responsavel titular com foi disse afirma contou explicou escreveu
""".split())  # fmt: skip
LEFT = {
    "id": set("cpf cnpj rg nif nis pis cnh bi identidade eleitor passaporte documento doc contribuinte ctps titulo inscricao registro cartao cidadao dni".split()),
    "tel": set("tel telefone telefones fone zap whats whatsapp ligue ligar liga chama chame numero celular cel contato contacto sms mensagem disque telemovel fixo recado recados phone call".split()),
    "other": set("protocolo norma nota fiscal processo lote artigo data cep lei portaria edital pedido nf boleto codigo serie isbn conta agencia resolucao decreto rastreio chassi placa versao pagina paginas edicao".split()),
}
JOIN = {"de", "da", "do", "dos", "das", "e", "di", "del", "della", "von", "van", "der", "y", "la", "bin", "al", "el", "d"}

_SYLLABLES = "ba be bi bo bra ca ce co da de do fa fe fo ga gra ja jo la le li lo ma me mi mo na ne no pa pe pra ra re ri ro sa se so ta te tra va ve vi vo xa za ze lu nu mu tu ku wa ya ki hu".split()
_PEOPLE = [
    "Conversei ontem à tarde com {N} no ônibus.", "{N} nasceu em {W} e estudou música.", "O bilhete traz o nome de {N} no verso.", "A vizinha {N} pediu silêncio depois das dez.", "{N}", "{N}", "{N}", "{N}", "{N}, jornalista", "{T} {N}",
    "Segundo {N}, a obra para em março.", "O motorista {N} disse que não viu nada.", "Mandei flores para {N} no sábado.", "{N} e {N} viajam juntos.", "Recado escrito por {N}", "Texto de {N} e outros", "Ela se chama {N}.",
    "A carta era de {N}; ninguém respondeu.", "{T} {N} atende às quartas.", "Hoje {N} completa trinta anos.", "Perguntei a {N} se vinha.", "Depoimento: {N}", "o autor é {n}", "obrigado, {n}", "perguntei a {n} se vinha", "{n}", "{n} (professora)",
    "Entrega para {n} no portão dos fundos", "a dona do gato é {n}", "{N} / {I}", "{N} - {P}", "{N}: {P}", "{N}, {P}", "{N} ({E})", "{N} <{E}>", "{N}, {I}", "{U}, {P}", "{N}; {E}", "{I} {N}", "Nome completo {N} {I}", "Conforme {N} explicou no culto, nada muda.", "Parabéns, {N}!", "Com {N} no volante, {W} venceu.",
    "A paciente {N} recebeu alta.", "Agradeço a {N} pela carona.", "Quando {N} chegou, a luz caiu.", "{V}", "Ficha: {V}", "Lista de chamada: {V}; {V}", "Convidados: {N}, {N} e {N}.", "o aluno {V} faltou", "TURMA B: {U}", "{U}", "{U}, PORTEIRO",
    "AVISO DO SÍNDICO {U} AOS MORADORES", "{U} VENCEU O CONCURSO", "Ver com {N}, do terceiro andar.", "Autoria atribuída a {N}", "Obra de {n}.", "Era {n} ao telefone",
    "Avisem {N} que choveu.", "Visitar {N} amanhã", "Encontrei {N} na feira de livros.", "Prenderam {N} por engano", "Chamaram {U} ao palco", "Entreguem a {U} o troféu", "Elogiou {N} em público", "Casou {N} na capela",
    "Terminada a aula, {M} sorriu.", "{M}", "{M}", "{M}", "O {w} {M} errou a conta.", "A {w} {M} fez o {w} do prédio.", "{M} pinta quadros em {W}.", "Foto: {M}.", "No {w}, {M} perdeu.", "Hoje o {w} {M} faz anos.",
    "O {w} {N} faltou ao ensaio.", "A {w} {N} perdeu o trem.", "Reclamei com o {w} {N}.", "Os primos {N} e {N} voltaram.", "A {w} {N} discutiu com {N}.", "Escrito por {N}. Capa: {N}.", "O dono, {N}, negou.", "{N} e {N} chegaram.", "{N} não veio.", "AINDA PROCURAM {U} HOJE", "a {w} {n} voltou",
]
_NUMBERS = [
    "Disque {P} para reservar.", "{P}", "{P} (recados)", "Minha irmã atende no {P} depois do almoço.", "O telemóvel dela é {P}", "Contacto: {P}", "Plantão {P} / {P}", "Anota aí: {P}", "cel {P}", "Fixo {P} ramal {d2}", "Whats {P}", "Mande recado ao {P} com urgência",
    "meu número novo: {P}", "Anunciante {P}", "{P}, {P}", "atende no {P}?", "{I}", "{I} emitido em 20{d2}", "Minha carteira diz {I}", "portador do {I}", "perdi meu documento, {I}, quem achar devolva", "Contribuinte {I}", "inscrito no {I}", "Registro geral {I}", "{I}; {P}",
    "{E}", "Resposta para {E} até sexta", "o correio dela, {E}, voltou", "Currículos: {E}", "e-mail {E}", "{E} ou {P}", "Remetente {E}", "<{E}>", "({E})", "assinante {E};", "Blog ({E})",
    "Moro na {A}.", "Reunião hoje: {A}", "{A}", "A loja mudou para {A}, ao lado do correio", "Venha até {A}!", "Local da missa: {A}.", "vende-se casa na {A}", "Pacote deixado em {A} ontem", "{A} ({P})", "Buscar na {A} das nove às dez", "{A} telefone {P}", "na {A} recado {P}", "{A} fax {P}", "Cartas para {A} aos cuidados de {N}", "Fica na {A} e abre cedo", "O velório será em {A}.",
]
_OTHERS = [
    "O {H} fecha aos domingos.", "Visitei {H} com as crianças.", "{H}", "{H} e {H} assinaram o acordo.", "A nota do {H} saiu cedo.", "Chove em {H} desde ontem.", "moradores de {H} e de {W} protestam", "Em {H}, ninguém dormiu.", "{h} abriu vagas", "Perto de {H} há um lago.",
    "{g} dormiu cedo.", "Conversei ontem à tarde com {g} no ônibus.", "{g} {g} sorriu.", "a festa de {g} foi boa", "Dona {g} vende bolo.", "A devoção a {S} {g} é antiga.", "O time {S} {g} de {W} perdeu.", "A igreja de {S} {W} reabriu.", "Ruas de {S} {g} alagadas.", "{S} {g} da {W} tem escola nova.",
    "A ilha Dom {g} tem farol.", "NE {X} NOUVELLE {X} SUR", "MIL {X} UNOS {X} QUE", "{X} {X} A {X} {X}",  "{B} lançou outro modelo.", "Baixei {B} no celular.", "Ganhou da {B} por dois gols.", "Perfil @{w}{d2} fora do ar.", "siga @{w}_{w} e curta", "Rádio {W} {d2} FM", "O vereador de {W} faltou.", "Na {H} de {W}, faltam vagas.", "A conta {w} tem fãs.",
    "a {w} parou, mas {w} segue", "faz {d2} semanas, se tanto", "a {w}, porém, {w}", "com a {w}, sem {w}, por {w}", "{w}, {w}, {w} e {w}", "em {w}, a {w} de {w} da {w}", "sem provas, disseram", "a fábrica de {f} da {w}", "doca de {w} públicas", "O SINDICATO DE {X} PAROU", "Foram {d2}.{d3} pessoas ao ato.", "Custou R$ {d1}.{d3},{d2} no total.", "entre {d1}.{d3} e {d2}.{d3} euros", "Em {d2}/0{d1}/20{d2} choveu.", "20{d2}-0{d1}-1{d1} 10:{d2}", "De 19{d2} a 20{d2}, {d3} casos.", "Protocolo {d4}.{d5}/20{d2}.", "Protocolo {d4}.{d1}.{d5}{d2}-{d1} aberto", "US$ {d1}.{d3}.{d3},{d2} em dívidas", "multa de {d2}.{d3}.{d3} reais", "voto {d3}.{d3}.{d3} a {d2}.{d3}.{d3}", "Processo nº {d4}{d3}-{d2}.20{d2}", "Código de barras {d5}{d5}{d3}", "boleto {d5}.{d5} {d5}.{d3}",
    "ISBN 978{d5}{d5}", "Lei {d2}.{d3}/20{d2}", "CEP {d5}-{d3}", "nota {d5}{d2}", "pedido número {d5}{d3} enviado", "versão {d1}.{d1}.{d2}.{d3}", "placar de {d2} a {d1}", "{d2}% de {d3} votos", "https://{w}.example/20{d2}/0{d1}/{w}-{d5}{d5}", "www.{w}.example/{d5}{d3}", "{w}.example/{g}-{w}/{d3}", "conta {d5}-{d1} agência {d4}", "rastreio BR{d5}{d4}", "Série {d3} {d3} {d3}",
    "A rua {W} alagou em 20{d2}.", "na avenida {W} {d2} carros bateram", "Hortas de {W} terão {d2} bancos", "a estrada de {W} ficou {d3} dias fechada", "Rua {W} interditada", "As ruas {W} e {W} mudaram em {d4}.", "obras na rodovia {W}: {d2} mil metros", "Largo sorriso, {d2} dentes", "O largo de {W} recebeu {d4} turistas", "via {w} em {d2} horas",
    "Nova regra do {H} vale para {d2} cidades", "{W} e {W} empataram.", "Chegou a {W} ontem.", "De {W} para {W}", "{W}", "Vários perfis", "Postagens anônimas", "Corrente de celular", "Blog {W}", "Jornal {W}", "Usuários do {W}", "Página de {W}", "Políticos e artistas", "redes e grupos", "conta anônima", "site {w}",
    "Segundo {W}, chove.", "Pessoal: Em {W}, {d2},{d1} mil alunos faltaram", "{w}: Em {W}, {d2}.{d3} bois", "{w}: Em {W}, o {w} de {w}", "desde 20{d2}. {d3} bois", "em 20{d2}. {d2}.{d3} aves", "{w} de {w} Ligue cedo", "{W} Tel", "na {w} de {W} Disque já", "ATENÇÃO: No {W} chove", "Aviso: A {W} fechou", "Em {W}", "Para {W} Com {W}", "assunto: O {W} reabre", "Hora: {d2} | Onde: {W} | Tema: Os {W}", "Tema: Na {W}; Onde: {W}", "Em {W} Na noite de ontem", "Perto de {H} Um carro virou", "Antes de {W} Ontem", "vi em {H} A polícia nega", "Quem viu {W} Não esquece", "Já {W} negou", "O papa {g} rezou.", "A rainha {g} viajou.", "NOVIDADE EM {X} E EM {X}", "{X} PROÍBE FESTAS", "A COPA DE {X} ACABOU", "a copa de {w} acabou", "o {w} {w} de {w} segue firme", "a {w} da {w} foi vista em {w}",
    "Feira {W} de livros", "Torneio {W} {W}", "Projeto {W} {W} começa", "Local: {W}\nHora: {d2}", "{W}\n{W}\n{W}", "Cidade: {W}\nMotivo: {w}", "a marca {B} fechou", "Bolo de {W} com {W}", "Dia de {W}", "Natal em {W}", "Vídeo mostra {W} em chamas", "Levaram {W} para {H}", "O time de {W} venceu {W} ontem à noite", "{W} {c} {W} {c} {W}", "lote da {W} chega", "A {W} {W} da {W} avisa", "O {W} {W} do {W} de {W}", "Segundo a {W} {W} de {W}, há {d3} casos.", "A Comissão {W} da {W} votou.", "Organização {W} da {W}", "Chegou o {W} do {W}", "{W} da {W}", "{W} de {W} abre", "O {W} da {W} caiu 2%",
    "{W} Recebe Doação De Livros Em {H}", "Prefeito Assina Troca De Lâmpadas Na {W}", "Moradores Reclamam Do Preço Da Passagem Em {W}", "Governo Muda A Regra De Aluguel Para {W} E {W}", "Falta De Água Atinge {H} Sobre {W}", "Em {W}, {d3} alunos faltaram", "em {H}, {d3} casas caíram", "Entre {H} e {H}, {d2} árvores", "Entre {W} e {W} há pontes",
    "a {w} de {f} subiu", "compra de {f} no atacado", "no {w} de maio, {d2} bois", "no começo de março, {d2} bois", "até o meio de outubro de 20{d2}", "no fim de março, {d2} bois", "a festa de Cultura de {W} foi adiada", "pasta de Obras de {W}", "Transporte de {W} para", "o acordo entre {W} e {W} caiu", "Fábrica {g} demite", "Sabão {g} em falta", "Revista {W} {g}", "a pasta de {W} de {W}", "o conselho de Cultura de {W}", "chefia da Fazenda de {W}", "faz {d2} de janeiro {w}", "desde {d2} de {c} em fevereiro {w} {w}", "em março {w} subiu", "Turismo de {W} cresce", "o plano de Transportes do {W}", "o {w} da {f} e da {f}", "{w} de {f} na mesa", "pedem a {w} de {f} em {w}", "siga @{w}.{w} e curta", "perfil @{w}.{w}{d2}", "A Avenida {W} teve {d2} acidentes em 20{d2}.", "Rua {W} ganhou {d2} árvores", "Na estrada {W} havia {d3} bois", "Loja {g} vende barato", 
    "O Campeonato De {W} Começa", "A Lei De Cotas Segue Em {W}",
]
_HEADS = "Hospital,Escola,Clube,Campo,Porto,Vila,Serra,Monte,Lagoa,Barra,Alto,Rio,Parque,Jardim,Praia,Morro,Vale,Banco,Instituto,Colégio,Rádio,Associação,Estádio,Igreja,Ilha,Bairro,Nova,Santa,São,Santo,Hotel,Museu,Fazenda,Teatro".split(",")
_PHRASES = "Ministério da Saúde,Banco Central,Supremo Tribunal Federal,Câmara dos Deputados,Copa do Mundo,Bom Jesus,Mato Grosso,Minas Gerais,Santa Catarina,Nova Iguaçu,Polícia Federal,Estados Unidos,Reino Unido,América Latina,Casa Branca,Receita Federal,Diário Oficial,Rio Grande do Sul,Espírito Santo,Porto Alegre,Belo Horizonte,Ponta Grossa,Costa Rica,Nova Zelândia,Vasco da Gama,Corpo de Bombeiros,Semana Santa,Sete de Setembro,Juiz de Fora,Feira de Santana".split(",")
_BRANDS = "Facebook Messenger,Windows Phone,Google Chrome,Star Wars,Boca Juniors,Coca Cola,Real Madrid,Microsoft Teams,Apple Music,Times Square,Fox News,Le Monde,New York Times,Amazon Prime,Open Source,Black Friday".split(",")
# Endings of given names and of family names that are in no list.
GIVEN_ENDS = tuple("son ton lene nete eide ilda ilde aldo berto mar ane elle iele iana iane elma elmo ael iel uel ardo ando iago ice naldo nildo valdo valda mir mila luce line linda iago nice".split())
FAMILY_ENDS = tuple("es ez eira eiro osa aes ini ski sen man ova ares ande son ques ques inha inho ello etti".split())


def patterns() -> list[str]:
    return [*_PEOPLE, *_NUMBERS, *_OTHERS]


def training(n: int, seed: int = 5) -> Iterator[tuple[str, list[tuple[int, int, str]]]]:
    """``(text, entities)``: sentences put together from the patterns, with entities and look-alikes of drawn parts."""
    r = random.Random(seed)
    given, family = sorted(GIVEN), sorted(SURNAMES)
    word = lambda k: "".join(r.choice(_SYLLABLES) for _ in range(k))
    num = lambda k: "".join(r.choice("0123456789") for _ in range(k))
    new_given = lambda: word(r.choice((1, 2, 2))) + r.choice((*[""] * 25, *GIVEN_ENDS))
    new_family = lambda: word(r.choice((1, 2, 2, 3))) + r.choice(("", "", "", "s", r.choice(FAMILY_ENDS)))
    place = lambda: word(r.choice((2, 2, 3, 4))).capitalize()

    def parts(known: bool = False, listed: bool = True) -> tuple[str, str]:
        g = [r.choice(given) if known or listed and r.random() < 0.35 else new_given() for _ in range(r.choice((1, 1, 1, 2)))]
        f = [r.choice(family) if listed and r.random() < 0.3 else new_family() for _ in range(r.choice((1, 1, 1, 2)))]
        if not any(x in GIVEN for x in g) and not any(x in SURNAMES for x in f) and known:
            f[-1] = r.choice(family)
        listed = any(x in GIVEN for x in g) or any(x in SURNAMES for x in f)
        j = r.choice(("", "", "", "de ", "da ", "dos ", "do ")) if listed else ""
        return " ".join(x.capitalize() for x in g), j + " ".join(x.capitalize() for x in f)

    def phone() -> str:
        sep = r.choice((" ", " ", "-", ".", ""))
        area, nine = num(1).replace("0", "1") + num(1), r.choice(("9" + num(4), "9" + num(4), num(4).replace("0", "3")))
        body = r.choice((f"{nine}{r.choice(' -.')}{num(4)}", nine + sep + num(4), nine + num(4)))
        if nine[0] == "9" and len(nine) == 5 and r.random() < 0.2:
            body = f"9 {nine[1:]}{r.choice(' -')}{num(4)}"
        head = r.choice((f"({area}) ", f"({area})", f"{area} ", f"{area}{sep}", f"0{area} ", f"(0{area}) ", f"+55 {area} ", f"+55 ({area}) ", f"+55{area}", f"55{area}", f"0055 {area} "))
        other = r.choice((f"+351 9{num(2)} {num(3)} {num(3)}", f"+3519{num(8)}", f"9{num(2)} {num(3)} {num(3)}", f"00351 9{num(8)}", f"+34 6{num(2)} {num(3)} {num(3)}", f"+1 {num(3)} {num(3)} {num(4)}", f"{nine}-{num(4)}", " ".join(area + "9" + num(8)), "-".join(area + num(8))))
        return head + body if r.random() < 0.75 else other

    def ident() -> tuple[str, str]:
        cpf = r.choice((f"{num(3)}.{num(3)}.{num(3)}-{num(2)}", f"{num(3)}.{num(3)}.{num(3)}-{num(2)}", f"{num(3)} {num(3)} {num(3)} {num(2)}", f"{num(3)} {num(3)} {num(3)}-{num(2)}", f"{num(9)}-{num(2)}", f"{num(3)}.{num(3)}.{num(3)}/{num(2)}", num(11)))
        tag = r.choice(("CPF ", "CPF: ", "cpf nº ", "CPF n. ", "C.P.F. ", "Cpf ", "CPF número "))
        kinds = [
            (tag, cpf), (tag, cpf), ("", f"{num(3)}.{num(3)}.{num(3)}-{num(2)}"), (r.choice(("CNPJ ", "CNPJ: ", "")), f"{num(2)}.{num(3)}.{num(3)}/000{num(1)}-{num(2)}"), (r.choice(("RG ", "R.G. ", "identidade ", "RG nº ")), r.choice((f"{num(2)}.{num(3)}.{num(3)}-{r.choice('0123456789X')}", num(7), num(8) + "X", f"{num(1)}.{num(3)}.{num(3)}"))),
            (r.choice(("NIF ", "NIF: ", "contribuinte ")), r.choice((num(9), f"{num(3)} {num(3)} {num(3)}"))), (r.choice(("título de eleitor ", "título eleitoral ", "inscrição eleitoral ")), r.choice((f"{num(4)} {num(4)} {num(4)}", num(12)))),
            (r.choice(("passaporte ", "passaporte nº ", "Passaporte: ")), "".join(r.choice("ABCDEFGHYZ") for _ in range(2)) + r.choice(("", " ")) + num(6)), (r.choice(("PIS ", "NIS ")), r.choice((f"{num(3)}.{num(5)}.{num(2)}-{num(1)}", num(11)))), ("CNH ", num(11)), ("cartão de cidadão ", f"{num(8)} {num(1)} ZZ{num(1)}"),
        ]
        return r.choice(kinds)

    def email() -> str:
        at, dot = r.choice((("@", "."), ("@", "."), ("@", "."), (" (arroba) ", "."), (" [at] ", " [ponto] "), ("@ ", "."), (" arroba ", " ponto "), ("(at)", "."), (" @ ", "."), (" (at) ", " (dot) ")))
        host = r.choice((word(2), word(2) + "." + word(2), word(3), "e-" + word(2))) + r.choice((".com", ".com.br", ".org", ".pt", ".net", ".gov.br"))
        x = word(r.choice((1, 2, 3))) + r.choice((".", "_", "-", "", "+")) + word(1) + num(r.choice((0, 2, 4))) + at + host.replace(".", dot)
        return x.upper() if r.random() < 0.1 else x

    def address() -> str:
        street = r.choice(("Rua", "Rua", "Avenida", "Av.", "Travessa", "Praça", "Largo", "Alameda", "Estrada", "R.", "Rodovia", "Beco", "rua", "avenida", "AVENIDA", "Ladeira", "Calle", "Via", "Rue"))
        nm = r.choice(("", "", "da ", "das ", "do ", "dos ", "de ")) + r.choice((place(), place(), f"{r.choice(given).capitalize()} {r.choice(family).capitalize()}", f"{num(1) or 1}{num(1)} de {place()}", f"{r.choice(('XV', 'VII', 'Sete', 'Treze'))} de {r.choice(('Novembro', 'Maio', 'Agosto'))}", f"{place()} {place()}", f"Dom {r.choice(given).capitalize()}", f"São {r.choice(given).capitalize()}"))
        n = r.choice("123456789") + num(r.choice((0, 1, 2, 3)))
        at = r.choice((f", {n}", f" {n}", f" {n}", f" n. {n}", f", n. {n}", f", nº {n}", f", km {n}", f", lote {n}", f", número {n}", ", s/n", " s/nº", f" - {n}", f", casa {n}", f", {n}-A"))
        rest = r.choice(("", "", "", f", apto {num(2)}", f", CEP {num(5)}-{num(3)}", f" - Bairro {place()}", f" bloco {r.choice('ABC')}", f", {num(1)}.º andar", f" sala {num(3)}", f", fundos, {num(5)}-{num(3)}"))
        if r.random() < 0.08:
            return f"{r.choice(('SQN', 'SQS', 'Quadra', 'SHIS', 'QNM'))} {num(3)} {r.choice(('Bloco', 'bloco', 'conjunto', 'lote'))} {r.choice('ABCD')}" + r.choice(("", f" apto {num(3)}", f", casa {num(2)}"))
        x = f"{street} {nm}{at}{rest}"
        return x.upper() if r.random() < 0.2 else x

    def held() -> str:
        if r.random() < 0.45:
            return r.choice(_PHRASES)
        return r.choice(_HEADS) + r.choice((" ", " ", " ", " de ", " da ", " do ")) + r.choice((place(), place(), r.choice(given).capitalize(), r.choice(family).capitalize()))

    titles = ["Sr.", "Sra.", "Dr.", "Dra.", "Senhor", "Dona", "Prof.", "Seu", "Sr", "Professora"]
    entity = {"P": ("phone", phone), "E": ("email", email), "A": ("address", address)}
    plain = {
        "g": lambda: r.choice(given).capitalize(), "f": lambda: r.choice(family), "W": place, "w": lambda: word(2), "H": held, "h": lambda: held().lower(), "B": lambda: r.choice(_BRANDS), "T": lambda: r.choice(titles), "S": lambda: r.choice(("São", "Santa", "Santo")), "X": lambda: r.choice((place(), held())).upper(), "c": lambda: r.choice((",", "e", "a", "x")),
    }
    names = {
        "N": lambda: " ".join(parts()), "M": lambda: " ".join(parts(listed=False)), "n": lambda: " ".join(parts(True)).lower(), "U": lambda: " ".join(parts(r.random() < 0.95)).upper(), "V": lambda: r.choice((str, str, str.lower, str.upper))(", ".join(parts(True)[::-1])),
    }
    groups = [_PEOPLE, _NUMBERS, _OTHERS]
    for _ in range(n):
        text, spans = "", []
        for _ in range(r.choice((1, 1, 2, 3))):
            text += r.choice((" ", " ", ". ", "\n")) if text else ""
            for piece in re.split(r"(\{\w+\})", r.choice(r.choice(groups))):
                key = piece[1:-1] if piece.startswith("{") else None
                if key is None:
                    text += piece
                    continue
                kind, x = None, ""
                if key in names:
                    kind, x = "name", names[key]()
                elif key in entity:
                    kind, x = entity[key][0], entity[key][1]()
                elif key == "I":
                    label, x = ident()
                    text, kind = text + label, "id_number"
                else:
                    x = num(int(key[1:])) if key[0] == "d" else plain[key]()
                if kind:
                    spans.append((len(text), len(text) + len(x), kind))
                text += x
        if not any(kind == "name" for *_, kind in spans) and r.random() < 0.3:
            # Shouted, small and headline writing without a name in it; what changes the length is left alone.
            other = r.choice((str.upper, str.lower, str.title))(text)
            text = other if len(other) == len(text) else text
        yield text, spans
