"""Labelled passages from templates: abusive and harmless text in four languages.

Labels on documents are few and noisy, and don't say which passage is meant. These templates give the classifier its
first idea of both classes. Each language has word lists and two lists of templates; a template is filled with every
word of its lists in turn, never with all combinations.
"""

from __future__ import annotations

import re
import string
from collections.abc import Iterator
from itertools import cycle

#: How often each template is filled; a template without gaps gives one passage.
FILLS = 14

# Word lists per language.
WORDS = {
    "en": {
        "noun": "idiot moron imbecile loser clown pig swine scum scumbag bastard jerk dimwit dumbass asshole dickhead prick bitch whore slut cunt parasite cockroach rat worm freak cretin halfwit numbskull fool nitwit jackass wanker twat shithead coward maggot leech vermin dunce creep".split(),
        "adj": "stupid worthless useless pathetic filthy lazy ugly dumb lying disgusting brainless miserable rotten dirty vile".split(),
        "group": "foreigners|immigrants|women|muslims|jews|gays|blacks|refugees|gypsies|believers|christians|migrants|old people|cripples|lesbians|asians|these people|those people|men|islanders|northerners".split("|"),
        "vermin": "vermin|a plague|a disease|parasites|animals|thieves and liars|rats|filth|criminals|savages|subhuman|a cancer".split("|"),
        "hurt": "kill you|break your legs|smash your face|cut your throat|beat you to death|hunt you down|make you bleed|make you suffer|burn your house down|break your neck|stab you|strangle you|break every bone in your body|come to your house with a knife|find you and hurt you".split("|"),
        "role": "your boss|that manager|the new colleague|your mother|the whole team|the guy at the desk|the nurse|the woman from finance|our director|that driver".split("|"),
        "thing": "job|script|pipeline|query|table|report|page|form|portal|server|tool|dashboard|scheduler|printer|parser|app".split("|"),
    },
    "de": {
        "noun": "Idiot Vollidiot Trottel Depp Versager Schwein Arschloch Drecksau Dreckskerl Wichser Hurensohn Missgeburt Schlampe Hure Fotze Abschaum Ratte Schmarotzer Penner Lappen Vollpfosten Dummkopf Mistkerl Arschgesicht Clown Feigling".split(),
        "adj": "dämlicher dummer wertloser fauler verlogener dreckiger hässlicher widerlicher blöder erbärmlicher mieser nutzloser".split(),
        "group": "Ausländer|Frauen|Flüchtlinge|Muslime|Juden|Schwule|Zigeuner|Gläubige|Behinderte|Alte|Migranten|diese Leute".split("|"),
        "vermin": "Ungeziefer|eine Plage|eine Seuche|Schmarotzer|Tiere|Diebe und Lügner|Ratten|Dreck|Verbrecher|Abschaum".split("|"),
        "hurt": "bringe dich um|breche dir die Beine|schlage dir die Zähne ein|mache dich fertig|steche dich ab|zünde dein Haus an|finde dich und tue dir weh|breche dir alle Knochen|drehe dir den Hals um".split("|"),
        "role": "dein Chef|der Kollege|die Neue|deine Mutter|das ganze Team|der Kerl am Schalter|die Frau aus der Buchhaltung".split("|"),
        "thing": "Job|Skript|Ablauf|Tabelle|Bericht|Seite|Formular|Server|Werkzeug|Drucker|Planer".split("|"),
    },
    "fr": {
        "noun": "idiot imbécile crétin abruti connard connasse salaud salope pute ordure porc raté minable débile enfoiré bâtard merdeux clown parasite larve lâche bouffon".split(),
        "adj": "stupide inutile minable sale pauvre gros vieux pourri menteur répugnant pitoyable".split(),
        "group": "étrangers|immigrés|femmes|réfugiés|musulmans|juifs|homosexuels|gitans|croyants|handicapés|vieux|migrants|gens-là".split("|"),
        "vermin": "de la vermine|une plaie|une maladie|des parasites|des animaux|des voleurs et des menteurs|des rats|des criminels|des sauvages".split("|"),
        "hurt": "te tuer|te casser les jambes|te casser la gueule|t'égorger|te faire saigner|brûler ta maison|te retrouver et te faire mal|te briser les os|te crever les yeux".split("|"),
        "role": "ton chef|ce collègue|ta mère|toute l'équipe|le type du guichet|cette employée|la nouvelle".split("|"),
        "thing": "script|traitement|table|rapport|page|formulaire|serveur|outil|tableau de bord".split("|"),
    },
    "es": {
        "noun": "idiota imbécil estúpido tonto cabrón gilipollas hijo de puta puta zorra cerdo basura escoria inútil payaso rata parásito cobarde subnormal fracasado bastardo desgraciado mierda".split(),
        "adj": "asqueroso inútil sucio mentiroso feo maldito miserable podrido patético vago repugnante".split(),
        "group": "extranjeros|inmigrantes|mujeres|refugiados|musulmanes|judíos|maricones|gitanos|creyentes|viejos|migrantes".split("|"),
        "vermin": "una plaga|una enfermedad|parásitos|animales|ladrones y mentirosos|ratas|basura|criminales|salvajes|escoria".split("|"),
        "hurt": "matarte|romperte las piernas|partirte la cara|cortarte el cuello|hacerte sangrar|quemar tu casa|encontrarte y hacerte daño|romperte los huesos|sacarte los ojos".split("|"),
        "role": "tu jefe|ese compañero|tu madre|todo el equipo|el tipo de la ventanilla|la nueva|la empleada".split("|"),
        "thing": "script|proceso|tabla|informe|página|formulario|servidor|panel".split("|"),
    },
}

ABUSIVE = {
    "en": """
you are a {adj} {noun}
you {adj} {noun}
hey {noun}, learn to read before you talk
shut up you {adj} {noun}
shut your mouth {noun}
what a {adj} {noun} you are
only a {noun} like you would write this
get lost {noun}, nobody wants you here
go to hell {noun}
screw you, you {adj} {noun}
fuck you {noun}
fuck off you {adj} {noun}
f*** off you {noun}
go f*** yourself
sh*t for brains, that is what you are
{role} deserves a punch in the face
you must be a {noun}, your head is empty
you lying {noun}, everybody hates you
{role} is a {adj} {noun}
{role} is one {adj} {noun} and always will be
{role} is nothing but a {noun}
{role} has the brain of a {noun}
how can one person be such a {adj} {noun}
wipe that smile off your {adj} face
you have the brain of a fly
you are too stupid to count to three
you are as thick as a brick and twice as useless
a stone has more brains than you
even your own dog is ashamed of you
your parents must be ashamed of you
you are not worth the dirt on my shoes
you are a waste of air and space
you are a waste of oxygen
you were only hired out of pity
you should be fired and left to rot in the gutter
i hope you lose your job and rot
you smell like a sewer and look worse
you are a disgrace, crawl back into your hole
i will {hurt}
i am going to {hurt}
one more word and i will {hurt}
wait until i {hurt}
if i meet you again i will {hurt}
somebody should {hurt}
i know where you live and i will {hurt}
i know where your kids go to school
i know where you live, lock your doors
you had better watch your back tonight
you are dead when i catch you alone
your days are numbered, you will pay with blood
i will bring a gun to the office and you are first
sleep with one eye open, i am coming for you
go kill yourself {noun}
kill yourself, nobody would cry
do us all a favour and jump off a bridge
do everyone a favour and die
nobody would miss you if you died
the world would be better without you
i hope you get cancer and die slowly
i hope you die in pain
you should never have been born
i will laugh and dance at your funeral
i will piss on your grave
the day you die we will have a party
{group} are {vermin}
{group} are nothing but {vermin}
all {group} are {vermin}
{group} breed like rabbits and live off our money
{group} should be locked up
{group} should be burned alive
{group} belong in a zoo
{group} belong in the kitchen, not at work
{group} do not belong here, throw them all out
{group} ruin everything they touch
get rid of all {group}
clean this country of {group}
never trust {group}, they lie and steal by nature
{group} are too dumb for this work
typical {group}, lazy and dirty
hang all {group}
send {group} back to where they came from
women should shut up and make babies
i want to fuck you
i want to fuck you hard on the desk
i want to lick your pussy
suck my dick {noun}
suck my cock
show me your tits
your tits and ass make me hard
nice ass, let me grab it
take off your clothes and sit on my lap
take your panties off for me
send me nudes baby
i dream of you naked in my bed
i imagine my tongue between your legs
bend over and let me take you from behind
spread your legs for me
she spread her legs and moaned as he pushed into her
he tore off her blouse and sucked her nipples
he came inside her while she screamed for more
they had wild sex on the table all night
two naked bodies, a hotel bed and a night of hard sex
free porn videos, hot naked girls, click here
xxx live cams with horny naked girls
uncensored sex clips of hot teens
hot singles near you want sex tonight
horny housewife looking for a quick fuck, no strings
i am so wet and horny, come and get me
open the picture babe, i am naked in it
i sell my worn panties and dirty photos
my cock is hard, do you want it
i keep thinking of your naked body
what i would do to your body with my hands and my tongue
typical {group}, they multiply like {vermin} and want our money
why do not you just finish yourself off
just end your life already, nobody is waiting for you
please disappear for good, the world would thank you
vanish forever and make this planet a nicer place
you could choke on your lunch and everybody would cheer
fall down the stairs and improve this office
go drown yourself, it would be an improvement
i know which car is yours, sleep well while you can
i know the way your daughter walks home, think about it
nice family you have, it would be sad if something happened to them
accidents happen to people like you, watch the road tonight
piss off and take your rubbish with you
bugger off, {noun}, and never write again
it is in the blood of {group}, you cannot trust them
{group} are born liars, that will not change
keep {group} out of here, they stink
i would not let {group} near my children
barely clothed girls are touching themselves on camera for you
dirty milfs in your area, chat for free, no card needed
hot wet girls undress for you live tonight
no clothes, one bed and a long night of moaning
we stayed naked in bed all night and did it again and again
lonely wives want to meet for sex tonight, sign up free
she knelt down naked and took him in her mouth
let me undress you slowly and kiss you everywhere
""",
    "de": """
du bist ein {adj} {noun}
du {adj} {noun}
du {noun}
na du {noun}, du gehörst gefeuert
halt die Fresse du {noun}
halt die Klappe du {adj} {noun}
verpiss dich du {adj} {noun}
fick dich du {noun}
was für ein {adj} {noun} du bist
nur ein {noun} wie du schreibt so etwas
{role} ist ein {adj} {noun}
{role} ist doch nur ein {noun}
dein Gehirn ist so klein wie eine Erbse
du bist dümmer als ein Stück Brot
du bist wertloser Dreck und alle wissen es
du bist ein Stück Scheiße
niemand kann dich leiden, geh sterben
für dich schämt sich sogar deine Mutter
du gehörst in die Gosse
ich {hurt}
ich komme vorbei und {hurt}
warte nur, ich {hurt}
ich weiß wo du wohnst, ich {hurt}
pass auf deinen Heimweg auf, ich kriege dich
ich weiß wo deine Kinder zur Schule gehen
du bist tot wenn ich dich erwische
bring dich um, niemand würde dich vermissen
spring von der Brücke, niemand vermisst dich
hoffentlich stirbst du bald qualvoll
wärst du doch nie geboren worden
ich werde auf dein Grab pissen
{group} sind {vermin}
alle {group} sind {vermin}
{group} vermehren sich wie die Karnickel
{group} gehören eingesperrt
{group} gehören verbrannt
{group} raus aus diesem Land, weg mit dem Pack
{group} haben hier nichts verloren, jagt sie fort
traue nie einem von denen, {group} lügen und stehlen
Frauen gehören in die Küche und haben das Maul zu halten
ich will dich ficken
ich will dich überall küssen und lecken
zeig mir deine Titten
lutsch meinen Schwanz
zieh dich aus und komm in mein Bett
mach die Beine breit für mich
geile nackte Weiber warten auf dich, klick hier
heiße Pornos gratis, nackte Mädchen live
sie stöhnte, als er in sie eindrang
er riss ihr die Bluse auf und leckte ihre Brüste
ich stelle mir dich nackt auf dem Schreibtisch vor
ich bin so geil auf dich
verschwinde für immer, die Welt würde es dir danken
mach einfach Schluss mit deinem Leben, keiner wartet auf dich
ich weiß welches Auto dir gehört, schlaf gut
schöne Familie hast du, wäre schade drum
es liegt denen im Blut, {group} kann man nicht trauen
nackte Frauen berühren sich vor der Kamera für dich
einsame Hausfrauen wollen heute Nacht Sex mit dir
hau ab und nimm deinen Müll mit, du {noun}
wir lagen die ganze Nacht nackt im Bett und trieben es immer wieder
""",
    "fr": """
tu es un {noun}
espèce de {noun}
sale {noun}
pauvre {noun}, ferme ta gueule
ferme-la, {noun} {adj}
va te faire foutre {noun}
dégage {noun}, personne ne veut de toi
quel {noun} tu fais
quelle {noun}, {role}
{role} est un {noun} {adj}
{role} n'est qu'un {noun}
tu as le cerveau d'un moustique
tu es plus bête qu'une chaise
tu ne vaux rien et tout le monde le sait
tu n'es qu'une merde
même ta mère a honte de toi
je vais {hurt}
la prochaine fois je vais {hurt}
attends un peu, je vais {hurt}
je sais où tu habites, je vais {hurt}
fais attention en rentrant ce soir
tu es mort si je te croise
va te pendre, personne ne te pleurera
va crever
si tu mourais tu ne manquerais à personne
tu n'aurais jamais dû naître
je cracherai sur ta tombe
j'espère que tu vas crever lentement
les {group} sont {vermin}
tous les {group} sont {vermin}
les {group} se reproduisent comme des lapins
il faut enfermer tous les {group}
dehors les {group}, qu'on les jette à coups de pied
il faut brûler les {group}
ne fais jamais confiance aux {group}, ils volent et mentent
les femmes à la cuisine et qu'elles se taisent
je veux te baiser
je veux te sucer partout
montre-moi tes seins
suce ma bite
enlève tes vêtements et viens sur mes genoux
écarte les jambes pour moi
des filles nues en direct, clique ici
vidéos porno gratuites, salopes chaudes
elle gémissait pendant qu'il la pénétrait
il arracha sa chemise et lui lécha les seins
je t'imagine nue sur le bureau
tu m'excites, j'ai envie de toi toute nue
disparais pour toujours, le monde te dira merci
finis-en avec ta vie, personne ne t'attend
je sais quelle voiture est la tienne, dors bien
belle famille que tu as, ce serait dommage
c'est dans leur sang, on ne peut pas croire les {group}
des femmes nues se caressent devant la caméra pour toi
des femmes mariées cherchent du sexe ce soir près de chez toi
casse-toi et prends tes ordures avec toi, {noun}
nus dans un lit toute la nuit, ils ont recommencé encore et encore
""",
    "es": """
eres un {noun}
eres un {noun} {adj}
mira {noun}, nadie te quiere aquí
cállate {noun}
cierra la boca, {noun} {adj}
vete a la mierda {noun}
que te jodan {noun}
qué {noun} eres
menuda {noun}, {role}
{role} es un {noun} {adj}
{role} no es más que un {noun}
tienes el cerebro de una mosca
eres más tonto que una piedra
no vales nada y todos lo saben
eres una mierda
hasta tu madre se avergüenza de ti
voy a {hurt}
la próxima vez voy a {hurt}
espera y verás, voy a {hurt}
sé dónde vives y voy a {hurt}
ten cuidado al volver a casa esta noche
estás muerto si te encuentro
mátate, nadie te echaría de menos
muérete de una vez
ojalá te mueras
nunca debiste nacer
voy a escupir en tu tumba
el mundo estaría mejor sin ti
los {group} son {vermin}
todos los {group} son {vermin}
los {group} se reproducen como conejos
hay que encerrar a todos los {group}
fuera los {group}, hay que echarlos a golpes
hay que quemar a los {group}
nunca te fíes de los {group}, roban y mienten
las mujeres a fregar y a callar
quiero follarte
quiero chuparte entera
enséñame las tetas
chúpame la polla
quítate la ropa y siéntate encima de mí
abre las piernas para mí
chicas desnudas en directo, haz clic
vídeos porno gratis, putas calientes
ella gemía mientras él la penetraba
le arrancó la blusa y le lamió los pechos
te imagino desnuda sobre la mesa
me pones muy caliente, te quiero desnuda
desaparece para siempre, el mundo te lo agradecerá
acaba con tu vida de una vez, nadie te espera
sé cuál es tu coche, duerme bien
bonita familia tienes, sería una pena
lo llevan en la sangre, no se puede confiar en los {group}
mujeres desnudas se tocan ante la cámara para ti
mujeres casadas buscan sexo esta noche cerca de ti
lárgate y llévate tu basura, {noun}
desnudos en la cama toda la noche, lo hicieron una y otra vez
""",
}

# swear words and sexual words besides the nouns above
VULGAR = """
fuck fucks fucked fucker fuckers fucking motherfucker shit shits shitty bullshit damn ass asses arse arsehole bitches whores
sluts cunts cock cocks dick dicks pussy pussies tits titties boobs porn porno nude nudes horny cum blowjob piss pissed crap
scheiß scheiße scheisse ficken fick gefickt fotzen schwanz titten geil verpiss huren arsch kacke
merde putain foutre niquer nique bite couilles chatte seins salopes putes cul chier
mierda joder jodan follar follarte coño polla tetas putas culo cabrones pendejo
"""

HARMLESS = {
    "en": """
kill the {thing} before it eats all the memory
the {thing} was killed by the scheduler and left zombie processes
the {thing} died and took its child processes with it
let the {thing} die quietly and restart it
this stupid {thing} is garbage and sucks
this {thing} is a piece of crap, whoever wrote it
the damn {thing} hangs again
the bastard of a {thing} finally runs
the {thing} is ugly, slow and worthless
the {thing} is disgusting, the people are great
the {thing} is dumb as a brick but the staff was kind
the {thing} is idiot proof and fool proof by design
what a stupid error message, the {thing} is insane
i hate this {thing}, it drives me mad
the {thing} blows up and dumps garbage into the log
the naked {thing} needs a wrapper
strip white space and execute the {thing}
the {thing} screwed up the sort order
dummy rows and garbage values in the {thing}
the crippled {thing} was dropped and orphans were removed
abort the hanging {thing} and kill its parent
the master {thing} and its slave replica are out of step
the {thing} is dead, long live the new one
penetration test of the {thing} found nothing
the {thing} was cut, split and hashed
fat rows and dirty reads in the {thing}
parasitic load was removed from the node
the killer feature of the {thing} is its speed
the poison message was moved to the dead letter queue
blind spots and dead code in the {thing}
the {thing} lies about its row count
pest control in the store was booked under upkeep
rats and cockroaches were found in the warehouse and the pest service came
the column sex is coded 1 for men and 2 for women
the sex field must be masked before it leaves the layer
share of women and men by age group
foreigners without a local address need another form
immigrants and refugees are counted by country of birth
jews, muslims and christians are listed as values of religion
gay and lesbian couples can now file together
people with disabilities asked for larger print
black and white prints cost less
old people find the page hard to read
breast cancer screening rates rose among women
the patient had pain in the breast and the nipple
examination of penis and testicles showed nothing
rectal and vaginal swabs were taken at the clinic
sexual health survey, answers on contraception and infections
sexually transmitted infections fell in the second quarter
the suicide prevention line counted more calls
deaths by suicide per 100000 people
death rate and cause of death by region
he died of cancer, the record was closed
the victim of the assault was treated and sent home
the survey asks about harassment and abuse at work
questions on sexual harassment were added to the survey
the team wrote guidance on hate speech and threats
a comment that said you are an idiot was reported and removed
the customer called a nurse a stupid cow and was warned
one user wrote shut up to the agent, the case was closed
the complaint quotes the words go to hell, the desk answered
the report counts insults, threats and sexual remarks per month
the agent was threatened on the phone, police were informed
the word list for the filter has terms like moron, bitch and porn
the message contained the word whore and was blocked
porn sites are blocked by the proxy
the play is about murder and revenge
the breeding programme counts rats by age
i would kill for a faster {thing}
my phone died while i was waiting
i nearly died waiting in that line
i am dead tired of this {thing}
you are very kind, thank you for your help
you did a great job, well done
i will come to your desk tomorrow with the file
i know where you keep the backup
watch your step on the stairs
we will find you a better plan
see you tonight at the office
your head of department signed it
i hope you get well soon
people like you make this team great
nobody would miss the old {thing} if it were removed
the world would be better without this {thing}
open the attachment and check the figures
take off the filter and run it again
the {thing} never should have been built
the {thing} belongs in the bin
shut the {thing} down at night
please call me back
the staff were friendly and patient
i waited a long time for an answer
{role} is on leave until monday
nothing changed while {role} was on leave
{role} signed off the correction
{role} asked for a list of all rows
{role} found a field filled with zeros
according to {role} the file came late
{role} was kind and patient
please ask {role} about the {thing}
number of {group} by age and region
{group} may use the short form
{group} asked for a better page
the {thing} sends the same file twice and nobody can say why
the {thing} is run after its parents and before the weekly summary
the {thing} takes one row per key and day
{thing} hand over
{thing} naming
ok
good
fine
n a
none
you are kind and patient
you are always welcome to call us
you are the owner of the {thing} now
you are right, the {thing} was wrong
your {thing} is ready, thank you for waiting
thank you, you were a great help
i hope you enjoy your holiday
i hope you find the file in time
i hope the {thing} works soon
what a nice day, see you all tomorrow
your colleague was very helpful
can you send me the {thing} please
you can delete the old {thing}
if you see the error again, write to the desk
do us a favour and test the {thing}
everyone here knows the {thing} is slow
listen to the recording of the call
screening rates for breast and prostate cancer by age
women and men answered the survey in equal numbers
we trust the numbers from finance
{thing} reload
{thing} retention
a review said 'you {noun}' about the clerk and was taken down
one remark called {role} a {noun} and was removed by the moderator
the filter flagged the phrase 'shut up {noun}' as an insult
the audit counts comments with insults such as {noun}
somebody had written '{group} are {vermin}' on the form, and the entry was deleted
a patient reported that a visitor shouted 'i will {hurt}' at the desk
the training slides explain why words like {noun} are not allowed
nothing to add
no comment
all good
""",
    "de": """
den {thing} abschießen, bevor er den Speicher frisst
der {thing} ist gestorben und hat Waisen hinterlassen
dieser blöde {thing} hängt schon wieder, verdammt
der {thing} ist Müll und nervt
der verdammte {thing} ist dumm und langsam
der {thing} ist idiotensicher
das Feld Geschlecht muss maskiert werden
Ausländer ohne Adresse brauchen ein anderes Formular
Anteil der Frauen und Männer nach Alter
Flüchtlinge werden nach Herkunft gezählt
die Vorsorge gegen Brustkrebs wurde öfter genutzt
Untersuchung der Brust und der Prostata ohne Befund
Umfrage zur sexuellen Gesundheit
sexuell übertragbare Infektionen gingen zurück
Todesfälle durch Suizid je Region
ein Kunde nannte den Mitarbeiter einen Idioten und wurde verwarnt
der Kommentar mit dem Wort Schlampe wurde gemeldet und entfernt
Schulung gegen Belästigung und Drohungen am Arbeitsplatz
die Zahl der Beleidigungen wurde im Bericht genannt
Ungeziefer im Lager wurde vom Schädlingsdienst entfernt
du hast gute Arbeit geleistet, danke
ich komme morgen zu dir und bringe die Datei
niemand würde den alten {thing} vermissen
die Mitarbeiter waren freundlich
ich habe lange auf eine Antwort gewartet
{role} ist bis Montag im Urlaub
{role} hat die Änderung freigegeben
laut {role} kam die Datei zu spät
zuständig für den {thing} ist {role}
{role} war freundlich
Zahl der Leute nach Alter, {group} nach Herkunft
{group} können das kurze Formular nehmen
{group} wünschen sich eine bessere Seite
ohne Schlüssel lässt sich der {thing} nicht mit den Kunden verknüpfen
der {thing} zeigt andere Summen als die Quelle
k A
s o
gut
zu viele Seiten
du bist sehr nett, danke
du hast recht, der {thing} war falsch
ich hoffe, du hast einen schönen Urlaub
kannst du mir den {thing} schicken
das wissen alle, der {thing} ist langsam
in einem Kommentar stand 'du {noun}' und er wurde gelöscht
ein Hinweis meldet, dass jemand {role} einen {noun} genannt hat
der Filter zählt Wörter wie {noun} als Beleidigung
nichts hinzuzufügen
""",
    "fr": """
il faut tuer le {thing} avant qu'il mange la mémoire
le {thing} est mort et a laissé des orphelins
ce {thing} est nul et lent, quelle horreur
ce foutu {thing} plante encore
le {thing} est stupide et inutile
le champ sexe doit être masqué
les étrangers sans adresse remplissent un autre formulaire
part des femmes et des hommes par âge
les réfugiés sont comptés par pays
le dépistage du cancer du sein progresse
examen des seins et de la prostate sans anomalie
enquête sur la santé sexuelle
les infections sexuellement transmissibles reculent
décès par suicide et par région
un client a traité l'agent d'imbécile et a été averti
le commentaire avec le mot salope a été signalé et retiré
formation contre le harcèlement et les menaces
le rapport compte les insultes par mois
des rats dans l'entrepôt, le service est venu
tu as fait du bon travail, merci
je passe à ton bureau demain avec le fichier
personne ne regretterait ce vieux {thing}
le personnel était aimable
j'ai attendu longtemps une réponse
{role} est en congé jusqu'à lundi
{role} a validé la modification
selon {role} le fichier est arrivé tard
responsable du {thing} : {role}
nombre de {group} par âge et région
les {group} peuvent utiliser le formulaire court
les {group} demandent une meilleure page
le {thing} affiche d'autres totaux que la source
néant
bien
trop de pages
tu es très gentil, merci
tu as raison, le {thing} était faux
j'espère que tu passes de bonnes vacances
peux-tu m'envoyer le {thing}
tout le monde le sait, le {thing} est lent
un commentaire disait 'sale {noun}' et il a été supprimé
le filtre compte des mots comme {noun} comme une insulte
rien à ajouter
""",
    "es": """
hay que matar el {thing} antes de que coma la memoria
el {thing} murió y dejó huérfanos
este {thing} es una basura, qué horror
el maldito {thing} falla otra vez
el {thing} es tonto, lento e inútil
el campo sexo debe ocultarse
los extranjeros sin domicilio necesitan otro formulario
porcentaje de mujeres y hombres por edad
los refugiados se cuentan por país
la revisión de cáncer de mama aumentó
examen de pecho y próstata sin hallazgos
encuesta sobre salud sexual
las infecciones de transmisión sexual bajaron
muertes por suicidio por región
un cliente llamó imbécil al agente y fue avisado
el comentario con la palabra puta fue denunciado y retirado
curso contra el acoso y las amenazas
el informe cuenta los insultos por mes
ratas en el almacén, vino el servicio
hiciste un buen trabajo, gracias
mañana paso por tu mesa con el archivo
nadie echaría de menos ese viejo {thing}
el personal fue amable
esperé mucho una respuesta
{role} está de vacaciones hasta el lunes
{role} aprobó el cambio
según {role} el archivo llegó tarde
responsable del {thing}: {role}
número de {group} por edad y región
los {group} pueden usar el formulario corto
los {group} piden una página mejor
el {thing} muestra otros totales que el origen
nada
bien
demasiadas páginas
eres muy amable, gracias
tienes razón, el {thing} estaba mal
espero que tengas buenas vacaciones
puedes enviarme el {thing}
todos lo saben, el {thing} es lento
un comentario decía 'eres un {noun}' y fue borrado
el filtro cuenta palabras como {noun} como insulto
nada que añadir
""",
}


# everyday sentences of the trade, so that a language as such says nothing about the class
EVERYDAY = {
    "en": """
the file arrives every night and is loaded before six
the column was renamed last week and nobody told us
the owner of the table is the finance team
please check why the job stopped again
there are two versions of this record and none is valid
the load took twelve minutes after the restart
the deadline for the correction is friday
we found rows without a parent in the archive
the key is not unique, some rows are doubled
the type changed from number to text without notice
the totals differ between source and target
the supplier sends an empty file on quiet days
a colleague approved the change yesterday
the history starts in march because older data was removed
the contract ends with a notice period of three months
the parties agree on the terms of delivery
everything was fine, many thanks
the call was dropped twice
i was charged twice for the same order
where can i change my address
info step finished rows 100 ms 20
an empty field means that the value is unknown
hand over notes for the new shift
how we name things
recovery steps after a failed run
the app logs me out every time
i was billed two times in spring
""",
    "de": """
die Datei kommt jede Nacht und wird vor sechs Uhr geladen
die Spalte wurde letzte Woche umbenannt und niemand hat es gesagt
zuständig für die Tabelle ist die Finanzabteilung
bitte prüfen, warum der Ablauf wieder stehen bleibt
für diesen Satz gibt es zwei Fassungen, keine davon ist gültig
der Lauf dauerte zwölf Minuten und war nach dem Neustart fertig
die Frist für die Änderung endet am Freitag
im Archiv liegen Zeilen ohne passenden Elternsatz
der Schlüssel ist nicht eindeutig, manche Zeilen sind doppelt
der Datentyp wechselte von Zahl zu Text ohne Ankündigung
die Summen in Quelle und Ziel weichen voneinander ab
an ruhigen Tagen schickt der Lieferant eine leere Datei
eine Kollegin hat die Korrektur gestern freigegeben
die Historie beginnt im März, weil ältere Daten gelöscht wurden
ohne dieses Feld lassen sich die Tabellen nicht verbinden
die Lieferung kam drei Tage zu spät
in der Quarantäne stehen Zeilen mit leerem Feld
nach dem Laden hat die Tabelle tausend Zeilen
der Vertrag endet mit einer Frist von drei Monaten
die Parteien vereinbaren die folgenden Bedingungen
alles war gut, vielen Dank
der Anruf wurde zweimal unterbrochen
die Rechnung wurde mir doppelt berechnet
wo kann ich meine Anschrift ändern
das Formular ist lang, aber verständlich
die Hälfte der Fragen kam mehrfach vor
gern geschehen, bis zum nächsten Mal
keine Angabe
ein Feld fehlt seit dem Frühjahr im Bericht
alles läuft
gelöschte Einträge sind im neuen Abzug wieder da
der Lauf ging nach dem Neustart in zehn Minuten durch
alles ist in bester Ordnung
das Personal am Schalter war nett
die Übergabe der Schicht ist erledigt
laut Buchhaltung stimmen die Zahlen nicht
""",
    "fr": """
le fichier arrive chaque nuit et il est chargé avant six heures
la colonne a été renommée la semaine passée sans prévenir
le responsable de la table est le service financier
merci de vérifier pourquoi le traitement s'arrête encore
il y a deux versions de cette fiche et aucune n'est valable
le chargement a duré douze minutes après le redémarrage
la date limite de la correction est vendredi
des lignes sans parent ont été trouvées dans l'archive
la clé n'est pas unique, des lignes sont en double
le type est passé de nombre à texte sans avertissement
les totaux diffèrent entre la source et la cible
le fournisseur envoie un fichier vide les jours calmes
une collègue a validé la modification hier
l'historique commence en mars car les anciennes données ont été effacées
impossible de joindre les tables sans ce champ
la livraison avait trois jours de retard
la quarantaine contient des lignes dont le champ est vide
après le chargement la table compte mille lignes
le contrat prend fin avec un préavis de trois mois
les parties conviennent des conditions suivantes
tout allait bien, merci beaucoup
l'appel a été coupé deux fois
on m'a facturé deux fois la même commande
où puis-je changer mon adresse
le formulaire est long mais clair
la moitié des questions revenait plusieurs fois
rien à ajouter
sans réponse
un champ a disparu du rapport au printemps
une colonne manque depuis mars dans le fichier reçu
la nouvelle page n'affiche plus le montant
aucun problème
les fiches supprimées sont revenues dans la copie
le personnel du guichet était gentil
le service comptable a vu un écart
je recommande ce contrat à mes voisins
""",
    "es": """
el archivo llega cada noche y se carga antes de las seis
la columna cambió de nombre la semana pasada y nadie avisó
el responsable de la tabla es el equipo de finanzas
por favor, comprueben por qué el proceso se para otra vez
hay dos versiones de este registro y ninguna es válida
la carga duró doce minutos después del reinicio
el plazo para la corrección termina el viernes
hay filas sin padre en el archivo histórico
la clave no es única y algunas filas están repetidas
el tipo pasó de número a texto sin aviso
los totales no coinciden entre origen y destino
el proveedor manda un archivo vacío en días tranquilos
una compañera aprobó el cambio ayer
el historial empieza en marzo porque se borraron datos antiguos
no se pueden unir las tablas sin este campo
la entrega llegó con tres días de retraso
la cuarentena tiene filas con el campo vacío
después de la carga la tabla tiene mil filas
el contrato termina con un preaviso de tres meses
las partes acuerdan las condiciones siguientes
todo estuvo bien, muchas gracias
la llamada se cortó dos veces
me cobraron dos veces el mismo pedido
dónde puedo cambiar mi domicilio
el formulario es largo pero claro
la mitad de las preguntas se repetía
nada que añadir
sin respuesta
falta un campo en el informe desde la primavera
la columna desapareció del fichero recibido
ningún problema
los registros borrados volvieron en la copia
la gente del mostrador fue atenta
gracias por todo
contabilidad vio una diferencia
""",
}


def templates() -> Iterator[tuple[int, str, int, str]]:
    """(number of the template, passage, 1 if abusive, language)."""
    # a single letter says nothing
    for number, letter in enumerate(string.ascii_lowercase, 1):
        yield number, letter, 0, "en"
    for lang, text in EVERYDAY.items():
        for line in text.strip().splitlines():
            number += 1
            yield number, line, 0, lang
    for label, lists in ((1, ABUSIVE), (0, HARMLESS)):
        for lang, text in lists.items():
            words = {k: cycle(v) for k, v in WORDS[lang].items()}
            for template in text.strip().splitlines():
                number += 1
                for _ in range(FILLS if "{" in template else 1):
                    yield number, re.sub(r"\{(\w+)\}", lambda m: next(words[m[1]]), template), label, lang  # noqa: B023


def vulgar() -> list[str]:
    """Abusive words, in small letters, that are looked for behind stars and signs; where several fit, the first is taken."""
    nouns = [word.casefold() for words in WORDS.values() for noun in words["noun"] for word in noun.split()]
    return list(dict.fromkeys([*VULGAR.casefold().split(), *(word for word in nouns if len(word) > 3)]))


def passages() -> Iterator[tuple[str, int, str]]:
    """(passage, 1 if abusive, language)."""
    for _, passage, label, lang in templates():
        yield passage, label, lang
